"""Plain definitions shared by the brute-force versions."""

import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def auc(y, s):
    """Probability that a row of label 1 scores higher than one of label 0 (ties count half)."""
    y, s = np.asarray(y), np.asarray(s)
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    n1 = int(y.sum())
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))
