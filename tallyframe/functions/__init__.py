"""Column builders: validation predicates, hashes and casts."""

from tallyframe.functions.digest import exact_text, row_digest
from tallyframe.functions.hashing import fingerprint, record_hash, row_hash60, version_key
from tallyframe.functions.predicates import (entity_rules, iso_date, money, one_of, positive_version,
                                             required, utc_timestamp)

__all__ = ["entity_rules", "exact_text", "fingerprint", "iso_date", "money", "one_of", "positive_version", "record_hash",
           "required", "row_digest", "row_hash60", "utc_timestamp", "version_key"]
