"""Selector-based final projection (B8) and column moves."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from yearweave.operators._common import SchemaMismatch
from yearweave.operators.guards import guard_columns


@dataclass(frozen=True)
class Selector:
    """A tidyselect-like selector; all kinds match case-insensitively."""
    kind: str  # "starts_with" | "contains" | "matches" | "ends_with"
    pattern: str

    def hits(self, columns: Sequence[str]) -> list[str]:
        p = self.pattern.lower()
        if self.kind == "starts_with":
            return [c for c in columns if c.lower().startswith(p)]
        if self.kind == "ends_with":
            return [c for c in columns if c.lower().endswith(p)]
        if self.kind == "contains":
            return [c for c in columns if p in c.lower()]
        if self.kind == "matches":
            rx = re.compile(self.pattern, re.IGNORECASE)
            return [c for c in columns if rx.search(c)]
        raise ValueError(f"unknown selector kind {self.kind!r}")


def starts_with(p: str) -> Selector:
    return Selector("starts_with", p)


def ends_with(p: str) -> Selector:
    return Selector("ends_with", p)


def contains(p: str) -> Selector:
    return Selector("contains", p)


def matches(p: str) -> Selector:
    return Selector("matches", p)


def resolve_columns(columns: Sequence[str], spec: Sequence[str | Selector]) -> list[str]:
    """Column list for ``spec``: bare names must exist; selectors may match
    nothing; first mention wins; columns not mentioned are dropped."""
    out: list[str] = []
    seen = set()
    missing = [s for s in spec if isinstance(s, str) and s not in columns]
    if missing:
        raise SchemaMismatch(f"column(s) not found: {', '.join(missing)}")
    for s in spec:
        for c in ([s] if isinstance(s, str) else s.hits(columns)):
            if c not in seen:
                seen.add(c)
                out.append(c)
    return out


def select_spec(df: DataFrame, spec: Sequence[str | Selector]) -> DataFrame:
    """The columns of ``spec``; guard columns not yet settled ride along, last."""
    guards = guard_columns(df)
    return df.select(*resolve_columns([c for c in df.columns if c not in guards], spec), *guards)


def move_to_front(df: DataFrame, front: Sequence[str]) -> DataFrame:
    front = [c for c in front if c in df.columns]
    return df.select(*front, *[c for c in df.columns if c not in front])
