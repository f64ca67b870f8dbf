"""Registered blocks of injected context: cut out when they are known, refused when they are not."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from siftline.functions import lexicons as L


@dataclass(frozen=True)
class Rule:
    """A block between two literals, its registered digests, and the record shapes that may carry it (any if empty)."""

    start: str
    end: str
    digests: frozenset[str]
    provenance: frozenset[str] = field(default_factory=frozenset)


@dataclass(frozen=True)
class Inspection:
    reason: str | None
    remaining: str | None
    fingerprints: tuple[str, ...]  # of the blocks cut out, one an occurrence


def fingerprint(block: str) -> str:
    return hashlib.sha256(re.sub(r"\s+", " ", block).strip().encode()).hexdigest()


class Inspector:
    """Applies rules in order, each to what the last one left; then looks for unknown instructions."""

    def __init__(self, rules: Sequence[Rule], unknown: Sequence[str] = L.UNKNOWN_INSTRUCTIONS):
        self.rules, self.unknown = tuple(rules), tuple(re.compile(p) for p in unknown)

    def __call__(self, text: str | None, provenance: str | None = None) -> Inspection:
        left, cut = text or "", []
        for rule in self.rules:
            kept, at = [], 0
            while (a := left.find(rule.start, at)) >= 0:
                b = left.find(rule.end, a + len(rule.start))
                if b < 0:
                    return Inspection("unresolved_injected_context", None, tuple(cut))
                b += len(rule.end)
                digest = fingerprint(left[a:b])
                if digest not in rule.digests or (rule.provenance and provenance not in rule.provenance):
                    return Inspection("unknown_injected_context", None, tuple(cut))
                cut.append(digest)
                kept.append(left[at:a])
                at = b
            left = "".join(kept) + left[at:]
        if any(p.search(left) for p in self.unknown):
            return Inspection("unknown_injected_context", None, tuple(cut))
        return Inspection(None, left, tuple(cut))
