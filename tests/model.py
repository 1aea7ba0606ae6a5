"""The ledger's rules in plain Python: what any order of loads must lead to.

A record is (entity, batch_id, source_record_id, fields, ingested_at); fields are texts, or None where a field is missing.
"""

import datetime as dt
import hashlib
import json
import re
from collections import defaultdict
from decimal import Decimal

from tallyframe import types as TT


def record_hash(entity, fields):
    told = {k: fields[k] for k in TT.payload_fields(entity) if fields.get(k) is not None}
    return hashlib.sha256(json.dumps(told, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def instant(text):
    try:
        return dt.datetime.strptime(text, "%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return None


def day(text):
    try:
        return dt.datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError:
        return None


def good(check, value):
    if value is None:
        return False
    if isinstance(check, tuple):
        return value in check
    return {"version": lambda: re.fullmatch("[0-9]+", value) and 0 < int(value) < 1 << 63,
            "utc timestamp": lambda: instant(value), "date": lambda: day(value),
            "money": lambda: re.fullmatch(r"[0-9]{1,16}([.][0-9]{1,2})?", value) and Decimal(value) > 0}[check]()


def reason(entity, fields):
    missing = [f"required:{f}" for f in sorted(TT.ENTITY_FIELDS[entity]) if not (fields.get(f) or "").strip(" ")]
    return ";".join(missing + [f for f, check in TT.CONTRACT[entity].items() if not good(check, fields.get(f))])


def state(records):
    """history [(customer, region, segment, from, to)], accounts {id: customer}, facts {id: (account, customer, version start, amount, status, memo)},
    quarantine [(entity, source_record_id, reason)]."""
    valid, quarantine = defaultdict(list), []
    for entity, batch, rid, fields, _ in records:
        why = reason(entity, fields)
        if why:
            quarantine.append((entity, rid, why))
        else:
            valid[entity].append((rid, fields, record_hash(entity, fields)))

    changes = defaultdict(dict)
    for _, f, h in valid["customers"]:
        at, rank = instant(f["effective_at"]), (int(f["change_version"]), h)
        if rank > changes[f["customer_id"]].get(at, ((0, ""), None))[0]:
            changes[f["customer_id"]][at] = (rank, (f["region"], f["segment"]))
    versions = {}
    for customer, found in changes.items():
        kept = []
        for at in sorted(found):
            if not kept or kept[-1][1] != found[at][1]:
                kept.append((at, found[at][1]))
        versions[customer] = [(at, kept[i + 1][0] if i + 1 < len(kept) else None, *attributes) for i, (at, attributes) in enumerate(kept)]

    winners = {}
    for rid, f, h in valid["accounts"]:
        rank = (int(f["record_version"]), h)
        if f["account_id"] not in winners or rank > winners[f["account_id"]][0]:
            winners[f["account_id"]] = (rank, f)
        if f["customer_id"] not in versions:
            quarantine.append(("accounts", rid, "customer_fk"))
    accounts = {a: f for a, (_, f) in winners.items() if f["customer_id"] in versions}

    facts = {}
    for rid, f, h in valid["transactions"]:
        account, at = accounts.get(f["account_id"]), instant(f["event_at"])
        held = [v for v in versions[account["customer_id"]] if v[0] <= at and (v[1] is None or at < v[1])] if account else []
        why = ("account_fk" if account is None else "account_currency" if account["currency"] != f["currency"]
               else "before_account_opening" if at.date() < day(account["opened_at"]) else "" if held else "customer_interval")
        if why:
            quarantine.append(("transactions", rid, why))
            continue
        rank = (int(f["record_version"]), instant(f["source_updated_at"]), h)
        if f["transaction_id"] not in facts or rank > facts[f["transaction_id"]][0]:
            facts[f["transaction_id"]] = (rank, (f["account_id"], account["customer_id"], held[0][0], Decimal(f["amount"]), f["status"], at, f["currency"], f.get("memo")))
    return (sorted(((c, r, s, a, b) for c, found in versions.items() for a, b, r, s in found), key=lambda r: (r[0], r[3])), {a: f["customer_id"] for a, f in accounts.items()},
            {t: v for t, (_, v) in facts.items()}, sorted(quarantine))


def payments(facts):
    """{(day, currency, channel-less): (count, amount)} of POSTED facts."""
    out = defaultdict(lambda: [0, Decimal(0)])
    for _, _, _, amount, status, at, currency, _ in facts.values():
        if status == "POSTED":
            out[at.date(), currency][0] += 1
            out[at.date(), currency][1] += amount
    return {k: tuple(v) for k, v in out.items()}


# --- what Spark's frames say, in the model's terms ----------------------------------------------

def history_of(df):
    return sorted(((r["customer_id"], r["region"], r["segment"], r["valid_from"], r["valid_to"]) for r in df.collect()), key=lambda r: (r[0], r[3]))


def accounts_of(df):
    rows = df.collect()
    assert len({r["account_id"] for r in rows}) == len(rows)
    return {r["account_id"]: r["customer_id"] for r in rows}


def facts_of(df, history):
    starts = {r["customer_version_id"]: (r["customer_id"], r["valid_from"]) for r in history.collect()}
    rows = df.collect()
    assert len({r["transaction_id"] for r in rows}) == len(rows)
    out = {}
    for r in rows:
        customer, start = starts[r["customer_version_id"]]
        assert customer == r["customer_id"]
        out[r["transaction_id"]] = (r["account_id"], customer, start, r["amount"], r["status"], r["event_at"], r["currency"], r["memo"] if "memo" in df.columns else None)
    return out


def quarantine_of(df):
    return sorted((r["entity"], r["source_record_id"], r["reason"]) for r in df.collect())


def raw_frame(spark, records):
    """Records as rows of the raw table."""
    rows = [(e, json.dumps({k: v for k, v in f.items() if v is not None}, ensure_ascii=False), b, rid, at) for e, b, rid, f, at in records]
    return spark.createDataFrame(rows, "entity string, payload string, batch_id string, source_record_id string, ingested_at timestamp")
