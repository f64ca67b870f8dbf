"""Column builders over text: folding, tokens, overlap, redaction, escaping."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions import lexicons as L


#: By rule, signs of which every match holds one: a cheap test before the pattern.
REDACTION_SIGNS = {"email": ("@",), "absolute_local_path": ("/Users/", "/private/", "/var/", "/tmp/"), "personal_name": (":", "="), "proprietary_identifier": (":", "=")}


def fold(text: Column) -> Column:
    """Case folding as far as lower case and sharp s go."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def tokens(text: Column) -> Column:
    """Distinct words of a-z, 0-9 and underscore."""
    return F.array_distinct(F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9_]+"), F.lit(0)))


def words(values: Sequence[str]) -> Column:
    return F.array(*(F.lit(v) for v in values))


def semantic_tokens(text: Column, stop: Sequence[str] = L.STOP_WORDS, synonyms: dict[str, str] = L.SYNONYMS) -> Column:
    """Distinct words of a-z and 0-9 after stop words and synonyms, of three signs or more."""
    raw = F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    same = F.create_map(*(F.lit(x) for pair in synonyms.items() for x in pair))
    kept = F.filter(raw, lambda w: ~w.isin(*stop))
    mapped = F.transform(kept, lambda w: F.coalesce(F.try_element_at(same, w), w))
    return F.array_distinct(F.filter(mapped, lambda w: F.length(w) > 2))


def shared(tokens_: Column, lexicon: Sequence[str]) -> Column:
    """How many words of a lexicon are among the tokens."""
    return F.size(F.array_intersect(tokens_, words(lexicon)))


def jaccard(a: Column, b: Column) -> Column:
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)))


def marketing_score(tokens_: Column, marketing: Sequence[str] = L.PROBE_MARKETING, decision: Sequence[str] = L.PROBE_DECISION, observed: Sequence[str] = L.PROBE_OBSERVED) -> Column:
    return shared(tokens_, marketing) * 5 + shared(tokens_, decision) * 2 + shared(tokens_, observed)


def collapse(text: Column) -> Column:
    """White space to single blanks, trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def fingerprint(text: Column) -> Column:
    return F.sha2(collapse(text), 256)


def entropy(text: Column) -> Column:
    """Shannon entropy in bits a character, by the characters of the text.

    An Arrow UDF, since counting by expression takes time by distinct characters x length.
    """
    import math
    from collections import Counter

    def bits(value: str | None) -> float:
        return math.fsum(n / len(value) * math.log2(len(value) / n) for n in Counter(value).values()) if value else 0.0

    @F.pandas_udf("double")
    def each(texts: pd.Series) -> pd.Series:
        return texts.map(bits).astype("float64")

    return each(text)


def escape_markup(text: Column) -> Column:
    """HTML escape that leaves entities alone, so that twice is once."""
    bare = F.regexp_replace(text, r"&(?!(?:amp|lt|gt|quot|#[0-9]+|#x[0-9a-fA-F]+);)", "&amp;")
    return F.replace(F.replace(bare, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def credential_ids(text: Column, rules: Sequence[tuple[str, str]] = L.CREDENTIALS) -> Column:
    """Sorted ids of the credential rules that match."""
    return F.array_sort(F.array_compact(F.array(*(F.when(F.regexp_like(text, F.lit(p)), F.lit(i)) for i, p in rules))))


def has_markup(text: Column) -> Column:
    out = F.lit(False)
    for pattern in L.MARKUP:
        out = out | F.regexp_like(text, F.lit(pattern))
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def redacted(text: Column, rules: Sequence[tuple[str, str, str]] = L.REDACTIONS) -> Column:
    """struct(text, count): ordered replacements, each on the text the last one left, and how many there were.

    A pattern is tried only on texts that hold one of the signs that each of
    its matches holds (REDACTION_SIGNS).
    """
    state = F.struct(text.alias("text"), F.lit(0).alias("count"))
    for rule in rules:
        state = let(state, _replacement(*rule))
    return state


def _replacement(name: str, pattern: str, by: str) -> Callable[[Column], Column]:
    def step(s: Column) -> Column:
        found = F.regexp_count(s["text"], F.lit(pattern))
        signs = REDACTION_SIGNS.get(name)
        if signs:
            found = F.when(reduce(or_, (F.contains(s["text"], F.lit(x)) for x in signs)), found).otherwise(0)
        return let(found, lambda n: F.struct(F.when(n > 0, F.regexp_replace(s["text"], pattern, by)).otherwise(s["text"]).alias("text"), (s["count"] + F.coalesce(n, F.lit(0))).alias("count")))

    return step


def redact(text: Column, rules: Sequence[tuple[str, str, str]] = L.REDACTIONS) -> tuple[Column, Column]:
    """(redacted text, number of replacements)."""
    state = redacted(text, rules)
    return state["text"], state["count"]


def high_entropy_secret():
    """Arrow UDF: whether a text holds a long, random token right after a sensitive word.

    Needs the place of each match, so no built-in expression will do.
    """
    import math
    import re
    from collections import Counter

    token, context = re.compile(L.SECRET_TOKEN), re.compile(L.SECRET_CONTEXT)
    overrides = [re.compile(p) for p in L.SECRET_OVERRIDES]

    def bits(value: str) -> float:
        return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())

    def found(text: str | None) -> bool:
        for m in token.finditer(text or ""):
            value = m[0]
            if len(value) >= L.SECRET_LENGTH and not any(o.fullmatch(value) for o in overrides) and context.search(text, max(0, m.start() - L.SECRET_PREFIX), m.start()) and bits(value) >= L.SECRET_ENTROPY:
                return True
        return False

    @F.pandas_udf("boolean")
    def check(texts: pd.Series) -> pd.Series:
        return texts.map(found)

    return check


def suggest(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: Column) -> Column:
    """The first rule of which a term is in the text."""
    out = None
    for value, terms in rules:
        hit = F.lit(False)
        for term in terms:
            hit = hit | F.contains(text, F.lit(term))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


def suggest_topic(topic: Column, text: Column) -> Column:
    by_text = suggest(F.concat(F.lit(" "), fold(text), F.lit(" ")), L.TEXT_TOPIC_RULES, F.lit("leadership_strategy"))
    return suggest(F.replace(fold(topic), F.lit("_"), F.lit(" ")), L.SOURCE_TOPIC_RULES, by_text)


def suggest_type(kind: Column) -> Column:
    return suggest(fold(kind), L.TYPE_RULES, F.lit("finding"))
