"""Content-addressed identities: prefix, then 24 hex digits of SHA-256."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions import lexicons as L

#: Stands for an unknown value wherever identities are hashed.
UNKNOWN = "?"
SEPARATOR = "\0"


def known(col: Column) -> Column:
    """The value, or the unknown mark at an identity's boundary."""
    return F.coalesce(col.cast("string"), F.lit(UNKNOWN))


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts with NUL between."""
    return F.sha2(F.concat_ws(SEPARATOR, *(known(p) for p in parts)), 256)


def stable_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(digest(*parts), 1, 24))


def canonical(**fields: Column) -> Column:
    """Canonical JSON of string fields: keys sorted, no spaces, unknown for null."""
    return F.to_json(F.struct(*(known(fields[k]).alias(k) for k in sorted(fields))))


def canonical_id(prefix: str, **fields: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(canonical(**fields), 256), 1, 24))


def evidence_uri(harness: Column, artifact: Column, version: Column, event: Column) -> Column:
    return F.concat(F.lit("session://"), harness, F.lit("/"), artifact, F.lit("@"), version, F.lit("#event="), event)


EVIDENCE_PATTERN = r"^session://([a-z0-9_-]+)/([a-z0-9_-]+)@([A-Za-z0-9._-]+)#event=([A-Za-z0-9._-]+)$"


def well_formed(uri: Column, grammar: str) -> Column:
    """Whether a URI follows the grammar of the probe, of review or of candidate documents; null does not."""
    return F.coalesce(F.regexp_like(uri, F.lit(L.EVIDENCE_GRAMMARS[grammar])), F.lit(False))


def parse_uri(uri: Column) -> dict[str, Column]:
    """Harness, artifact, version and event of an evidence URI; empty where it is none."""
    return {name: F.regexp_extract(uri, EVIDENCE_PATTERN, k) for k, name in enumerate(("harness", "artifact", "version", "event"), 1)}
