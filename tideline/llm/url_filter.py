"""URL filtering with a cascade of Bloom filters.

Level 1 encodes the listed keys. Level 2 encodes those keys of the corpus's
universe that pass level 1 without being listed, level 3 the listed keys that
pass level 2, and so on until a level lets nothing wrong through. For any key
of the universe, the first level that rejects it then decides membership
exactly: rejected by an odd level means not listed, by an even one listed.

The universe is every (host suffix, path prefix) pair that a URL of the corpus
can be looked up by. It is never shuffled whole: a scan keeps only the false
positives of level 1, which are then made distinct.

The cascade is shipped to every task, so its size is checked (``max_bytes``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (host, path) -> verdict, as the contract of op2 has them.
RULES = {("org", "/"): "allow", ("example.org", "/es/"): "block", ("example.org", "/en/1"): "block", ("com", "/fr/"): "allow", ("com", "/de/"): "block"}


@dataclass(frozen=True)
class Bloom:
    bits: np.ndarray  # uint8, one bit a key slot
    n_bits: int
    hashes: int
    seed: int

    @classmethod
    def of(cls, keys: Iterable[str], n_keys: int, seed: int, rate: float) -> "Bloom":
        n_bits = max(64, int(np.ceil(-n_keys * np.log(rate) / np.log(2) ** 2)))
        bloom = cls(np.zeros((n_bits + 7) // 8, np.uint8), n_bits, max(1, round(n_bits / max(1, n_keys) * np.log(2))) if n_keys else 1, seed)
        for key in keys:
            for slot in bloom.slots(key):
                bloom.bits[slot >> 3] |= 1 << (slot & 7)
        return bloom

    def slots(self, key: str) -> Iterator[int]:
        h = xxhash.xxh3_128_intdigest(key.encode(), self.seed)
        low, high = h & (1 << 64) - 1, (h >> 64) | 1
        return ((low + i * high) % self.n_bits for i in range(min(self.hashes, 24)))

    def __contains__(self, key: str) -> bool:
        return all(self.bits[s >> 3] >> (s & 7) & 1 for s in self.slots(key))


@dataclass(frozen=True)
class Cascade:
    """Exact for every key of the universe that it was built over."""

    levels: tuple[Bloom, ...]

    def __contains__(self, key: str) -> bool:
        for depth, bloom in enumerate(self.levels):
            if key not in bloom:
                return depth % 2 == 1
        return len(self.levels) % 2 == 1

    @property
    def n_bytes(self) -> int:
        return sum(b.bits.nbytes for b in self.levels)


def cascade(listed: Iterable[str], false_positives: Iterable[str], first: Bloom, rate: float = 0.5) -> Cascade:
    """Levels after ``first``, which encodes ``listed``; ``false_positives`` are the universe's keys that pass it unlisted."""
    levels, inside, outside = [first], list(listed), list(false_positives)
    while outside:
        level = Bloom.of(outside, len(outside), len(levels), rate)
        levels.append(level)
        inside, outside = outside, [k for k in inside if k in level]
    return Cascade(tuple(levels))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def lookups(host: str, path: str, lengths: list[int]) -> list[str]:
    """The keys a URL is looked up by, longest first: every suffix of its host at a dot with every listed length of path prefix."""
    hosts = [host, *(host[i + 1 :] for i, c in enumerate(host) if c == ".")]
    return sorted((h + path[:n] for h in hosts for n in lengths if n <= len(path)), key=len, reverse=True)


def filter_urls(pages: DataFrame, rules: Mapping[tuple[str, str], str] = RULES, default: str = "allow", url_col: str = "url", rate: float | None = None, max_bytes: int = 8 << 20, most_misses: int = 100_000) -> DataFrame:
    """pages with host, path, rule (the longest that fits, else null) and verdict (the rule's, else ``default``).

    Null URLs and those without ``://`` have empty host and path, fit no rule and get ``default``. Repeated rows
    each get their own verdict; an empty table gives an empty one. Columns of pages that have one of the four
    names are replaced. One cascade for each verdict; their total size is checked against ``max_bytes``.

    ``rate`` is the first level's share of false positives. By default it is listed / (sqrt(2) * universe), the
    universe taken as 16 lookups a URL, so that all levels together take O(log(universe / listed)) bits a listed
    key, however large the corpus: about 0.7 false positives a listed key are then sent to the driver. More than
    ``most_misses`` raise, as no cascade of that size would be small. Very long URLs cost a look-up for each dot of their
    host; rules of one length are equally near, so no two can tie.
    """
    listed = {verdict: [h + p for (h, p), v in rules.items() if v == verdict] for verdict in sorted(set(rules.values()))}
    lengths = sorted({len(p) for _, p in rules})
    rate = rate or min(0.5, len(rules) / (2**0.5 * 16 * max(1, pages.count())))
    first = {v: Bloom.of(keys, len(keys), 0, rate) for v, keys in listed.items()}
    known = {v: set(keys) for v, keys in listed.items()}
    _check_size(sum(b.bits.nbytes for b in first.values()), max_bytes)

    def wrong(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = {k for u in pdf[url_col].unique() for k in lookups(*split_url(u), lengths)}
            found = [(v, k) for v, bloom in first.items() for k in keys if k in bloom and k not in known[v]]
            yield pd.DataFrame(found, columns=["verdict", "key"])

    urls = pages.select(F.col(url_col).cast("string").alias(url_col))
    misses = urls.mapInPandas(wrong, "verdict string, key string").distinct().limit(most_misses + 1).collect()
    if len(misses) > most_misses:
        raise ValueError(f"the first level lets more than {most_misses} keys through; give a lower rate")
    outside: dict[str, list[str]] = {v: [] for v in listed}
    for row in misses:
        outside[row.verdict].append(row.key)
    filters = {v: cascade(listed[v], sorted(outside[v]), first[v]) for v in listed}
    _check_size(sum(c.n_bytes for c in filters.values()), max_bytes)

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(column: pd.Series) -> pd.DataFrame:
        out = []
        for url in column:
            host, path = split_url(url)
            rule = verdict = None
            for key in lookups(host, path, lengths) if host or path else ():
                verdict = next((v for v, c in filters.items() if key in c), None)
                if verdict:
                    rule = key
                    break
            out.append((host, path, rule, verdict or default))
        return pd.DataFrame(out, columns=["host", "path", "rule", "verdict"])

    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return pages.select(*kept, judge(F.col(url_col).cast("string")).alias("_judged")).select(*kept, "_judged.*")


def _check_size(n_bytes: int, max_bytes: int) -> None:
    if n_bytes > max_bytes:
        raise ValueError(f"the filter takes {n_bytes} bytes; max_bytes is {max_bytes}")
