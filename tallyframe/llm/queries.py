"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm.alignment import op13_pair_bitmaps
from tallyframe.llm.ann import op10_adaptive_scan
from tallyframe.llm.chat import op9_reply_trees
from tallyframe.llm.decontaminate import op7_suffix_automaton
from tallyframe.llm.exact import op12_two_pass_bloom
from tallyframe.llm.jaccard import op3_jaccard_prefix_orders
from tallyframe.llm.langid import op1_viterbi_langid
from tallyframe.llm.packing import op5_conflict_best_fit
from tallyframe.llm.paragraphs import op8_paragraph_minhash
from tallyframe.llm.periodic import op11_periodic_runs
from tallyframe.llm.quality import op4_byte_convnet
from tallyframe.llm.sharding import op6_hilbert_sharding
from tallyframe.llm.toxicity import op2_factorization_machine

ROOT = str(Path(__file__).resolve().parents[2])


#: Of Python workers: where this package is, and memory that goes back to the system as soon as an array is dropped.
WORKERS = {"PYTHONPATH": ROOT, "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "8388608", "MALLOC_TRIM_THRESHOLD_": "16777216"}


def with_code(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let Python workers import this package from the folder the driver imported it from, wherever the job was started, and keep them small."""
    @functools.wraps(query)
    def run(spark: SparkSession, *given) -> DataFrame:
        for name, value in WORKERS.items():
            spark.sparkContext.environment.setdefault(name, value)
        return query(spark, *given)

    return run


QUERIES = {name: with_code(query) for name, query in {
    "op1_viterbi_langid": op1_viterbi_langid,
    "op2_factorization_machine": op2_factorization_machine,
    "op3_jaccard_prefix_orders": op3_jaccard_prefix_orders,
    "op4_byte_convnet": op4_byte_convnet,
    "op5_conflict_best_fit": op5_conflict_best_fit,
    "op6_hilbert_sharding": op6_hilbert_sharding,
    "op7_suffix_automaton": op7_suffix_automaton,
    "op8_paragraph_minhash": op8_paragraph_minhash,
    "op9_reply_trees": op9_reply_trees,
    "op10_adaptive_scan": op10_adaptive_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_two_pass_bloom": op12_two_pass_bloom,
    "op13_pair_bitmaps": op13_pair_bitmaps,
}.items()}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op3_jaccard_prefix_orders": rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) n FROM shingle GROUP BY 1),
common AS (SELECT a.doc_id a, b.doc_id b, count(*) c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
bi AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM bi UNION SELECT r.a, l.b FROM reach r JOIN bi l ON r.b = l.a)
SELECT d.doc_id, coalesce(z.n, 0) n_shingles, least(d.doc_id, coalesce(m.least_id, d.doc_id)) component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) least_id FROM reach GROUP BY 1) m ON m.a = d.doc_id""",
    "op7_suffix_automaton": rf"""WITH item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
window_of AS (
  SELECT DISTINCT item_id, least(10, len(w)) n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) i FROM item WHERE len(w) > 0)),
words AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') s
  FROM (SELECT doc_id, w, l.n, unnest(generate_series(1, len(w) - l.n + 1)) i
        FROM words, (SELECT DISTINCT n FROM window_of) l WHERE len(w) >= l.n)),
found AS (SELECT p.doc_id, p.i, p.n, v.item_id FROM place p JOIN window_of v ON p.n = v.n AND p.s = v.s),
hit AS (SELECT doc_id, count(DISTINCT k) n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) k FROM found) GROUP BY 1),
ids AS (SELECT doc_id, count(*) n_items, string_agg(x, ',' ORDER BY x) x
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) x FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) n_words, coalesce(h.n_hit, 0) n_hit, coalesce(k.n_items, 0) n_items,
       sha256(coalesce(k.x, '')) items_sha256, coalesce(h.n_hit, 0) > 0 contaminated
FROM words d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN ids k ON k.doc_id = d.doc_id""",
    "op9_reply_trees": r"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') role, coalesce(text, '') text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
marked AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>') body,
         replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ':', '\:') head
  FROM turns)
SELECT conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) loss_sha256,
       CAST(sum(length('### ' || head || ': ' || body || '</turn>' || chr(10))) AS BIGINT) formatted_chars
FROM marked GROUP BY conv_id""",
    "op12_two_pass_bloom": r"""WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) text_sha256 FROM documents),
longest AS (SELECT text_sha256, count(*) group_size, max(n) n FROM rows GROUP BY 1),
stays AS (SELECT r.text_sha256, min(r.doc_id) keep_id FROM rows r JOIN longest g ON r.text_sha256 = g.text_sha256 AND r.n = g.n GROUP BY 1)
SELECT r.doc_id, s.keep_id, g.group_size, r.doc_id = s.keep_id kept, r.text_sha256
FROM rows r JOIN longest g ON g.text_sha256 = r.text_sha256 JOIN stays s ON s.text_sha256 = r.text_sha256""",
}
