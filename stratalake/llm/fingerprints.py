"""Document fingerprints from prefix polynomial hashes.

A prefix array holds, for every place in a text, the polynomial hash of what comes before it, modulo two primes. The hash of any
span follows from two entries, so spans of two texts are compared in constant time and their longest common extension is found
by binary search. A document's fingerprint is its length, the hash of the whole text, and the hashes of its beginnings and
endings at lengths that grow by a fixed factor. For what lies inside, it holds the number of distinct spans of ``SPAN`` characters,
taken at every place, and the ``KEPT`` least of their mixed hashes. The likeness of two fingerprints is the larger of two shares of
the longer text: the one covered by the longest common beginning and ending that they show, each found by binary search, and the
one of common spans, estimated from the least hashes and lowered by one standard error (exact where all hashes are kept).
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.tables import table

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_013)
#: Places hashed at once; powers are kept for so many places only.
BLOCK = 1 << 16
#: Factor between the lengths of beginnings and endings in a fingerprint.
GROWTH = 1.125
#: Characters of a span inside the text; span hashes that a fingerprint keeps at most.
SPAN = 24
KEPT = 128
#: Hash values of a span: two numbers below 2**31.
Hash = tuple[int, int]

_POWERS = []
for _p, _b in zip(PRIMES, BASES):
    _row = np.ones(1, np.uint64)
    while len(_row) < BLOCK:
        _row = np.concatenate((_row, _row * np.uint64(pow(_b, len(_row), _p)) % np.uint64(_p)))
    _POWERS.append(_row)
_INVERSES = tuple(pow(b, -1, p) for p, b in zip(PRIMES, BASES))
#: Powers of the first inverse, which move spans to place 0.
_BACK = np.ones(1, np.uint64)
while len(_BACK) < BLOCK:
    _BACK = np.concatenate((_BACK, _BACK * np.uint64(pow(_INVERSES[0], len(_BACK), PRIMES[0])) % np.uint64(PRIMES[0])))


def points(text: str) -> np.ndarray:
    """Code points, from 1 so that no character is a zero of the polynomial."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)


class PrefixHash:
    """Prefix arrays of one text: entry ``i`` is the sum of ``point[j] * base**j`` over ``j < i``, modulo each prime."""

    def __init__(self, text: str):
        codes = points(text)
        self.size = len(codes)
        self.rows = []
        for p, b, powers in zip(PRIMES, BASES, _POWERS):
            out, carry, prime = np.zeros(self.size + 1, np.uint32), 0, np.uint64(p)
            for at in range(0, self.size, BLOCK):
                part = codes[at : at + BLOCK]
                part = np.cumsum(part * powers[: len(part)] % prime) % prime
                if at:
                    part = (part * np.uint64(pow(b, at, p)) + np.uint64(carry)) % prime
                out[at + 1 : at + 1 + len(part)] = part
                carry = int(part[-1])
            self.rows.append(out)

    def span(self, start: int, length: int) -> Hash:
        """Hash of a span, the same wherever the span stands."""
        return tuple((int(r[start + length]) - int(r[start])) * pow(v, start, p) % p for r, p, v in zip(self.rows, PRIMES, _INVERSES))

    def inner(self) -> np.ndarray:
        """Mixed 32-bit hashes of the spans of ``SPAN`` characters at every place, in order."""
        row, p = self.rows[0], np.uint64(PRIMES[0])
        out = np.empty(max(0, self.size - SPAN + 1), np.uint32)
        for at in range(0, len(out), BLOCK):
            end = min(at + BLOCK, len(out))
            part = (row[at + SPAN : end + SPAN].astype(np.uint64) + p - row[at:end]) % p * _BACK[: end - at] % p
            if at:
                part = part * np.uint64(pow(_INVERSES[0], at, PRIMES[0])) % p
            part = part * np.uint64(0x9E3779B97F4A7C15)
            part ^= part >> np.uint64(29)
            out[at:end] = part * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)
        out.sort()
        return out

    def equal(self, start: int, other: PrefixHash, at: int, length: int) -> bool:
        return self.span(start, length) == other.span(at, length)

    def extension(self, start: int, other: PrefixHash, at: int, backwards: bool = False) -> int:
        """Length of the longest common extension from two places on (or, backwards, before them)."""
        low, high = 0, min(start, at) if backwards else min(self.size - start, other.size - at)
        while low < high:
            n = (low + high + 1) // 2
            back = n if backwards else 0
            low, high = (n, high) if self.equal(start - back, other, at - back, n) else (low, n - 1)
        return low


def lengths(size: int) -> list[int]:
    """Growing lengths below ``size``, the same for all texts as far as they go."""
    out, n = [], 1
    while n < size:
        out.append(n)
        n = max(n + 1, int(n * GROWTH))
    return out


def fingerprint(hashed: PrefixHash) -> str:
    """``size:whole:beginnings:endings:spans:least`` in hexadecimal, eight digits for each length and each kept span hash."""
    n = hashed.size
    grid = lengths(n)
    whole = "".join(f"{v:08x}" for v in hashed.span(0, n))
    starts = "".join(f"{v:08x}" for v in hashed.rows[0][grid].tolist())
    p, v = PRIMES[0], _INVERSES[0]
    total = int(hashed.rows[0][n])
    ends = "".join(f"{(total - int(hashed.rows[0][n - k])) * pow(v, n - k, p) % p:08x}" for k in grid)
    inner = hashed.inner()
    new = np.flatnonzero(np.diff(inner, prepend=inner[:1] ^ np.uint32(1)))
    least = "".join(f"{v:08x}" for v in inner[new[:KEPT]].tolist())
    return f"{n:x}:{whole}:{starts}:{ends}:{len(new):x}:{least}"


def _shared(a: str, b: str, grid: list[int]) -> int:
    """Longest length at which two lists of hashes agree; they agree up to some length and differ beyond."""
    low, high = 0, len(grid)
    while low < high:
        k = (low + high + 1) // 2
        at = slice(8 * k - 8, 8 * k)
        low, high = (k, high) if a[at] == b[at] else (low, k - 1)
    return grid[low - 1] if low else 0


def _inside(n: int, a: str, m: int, b: str) -> float:
    """Share of the larger set of spans that both hold, from the sizes and least hashes of two sets; a low estimate."""
    if not n or not m:
        return 0.0
    of_a, of_b = ({x[k : k + 8] for k in range(0, len(x), 8)} for x in (a, b))
    whole = n <= KEPT and m <= KEPT
    least = sorted(of_a | of_b)[: None if whole else KEPT]
    alike = sum(x in of_a and x in of_b for x in least) / len(least)
    if not whole:
        alike = max(0.0, alike - math.sqrt(alike * (1 - alike) / len(least)))
    # Of n + m spans, the share alike / (1 + alike) is common to both.
    return min(alike / (1 + alike) * (n + m), n, m) / max(n, m)


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, else the share of the longer text that both have, by ends or by spans (below 1)."""
    if a == b:
        return 1.0
    (n, _, a_start, a_end, a_spans, a_least), (m, _, b_start, b_end, b_spans, b_least) = a.split(":"), b.split(":")
    n, m = int(n, 16), int(m, 16)
    if not n or not m:
        return 0.0
    grid = lengths(min(n, m))
    # A text that is the whole beginning of the other has no entry for its full length; the last one below counts.
    both = _shared(a_start, b_start, grid) + _shared(a_end, b_end, grid)
    inside = _inside(int(a_spans, 16), a_least, int(b_spans, 16), b_least)
    return min(max(both / max(n, m), inside), min(n, m) / max(n, m), 1 - 1 / max(n, m))


def edited(text: str, following: str) -> str:
    """The second half (rounded down) replaced by as many first characters of the following text, or by all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(doc_id, text: str, following: str, hashed: PrefixHash, ahead: PrefixHash) -> tuple:
    changed = edited(text, following)
    altered = PrefixHash(changed)
    own, new, next_ = fingerprint(hashed), fingerprint(altered), fingerprint(ahead)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    common = hashed.extension(0, altered, 0), hashed.extension(0, ahead, 0)
    return doc_id, len(text), digest, own, new, likeness(own, new), likeness(own, next_), *common


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_edited long, common_next long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_edited", pa.int64()), ("common_next", pa.int64())])


def _results(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _pairs(batches):
    """Rows come by range, the range's own ones in order before the next range's first; each waits for the one after it."""
    held, out = None, []
    for batch in batches:
        for place, extra, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            if extra and (held is None or held[0] != place):
                continue  # another row with the key of the next range's first one
            hashed = PrefixHash(text)
            if held is not None and held[0] == place:
                out.append(_row(held[1], held[2], text, held[3], hashed))
            held = None if extra else (place, doc_id, text, hashed)
            if len(out) >= 200:
                yield _results(out)
                out = []
    if out:
        yield _results(out)


def _cuts(keyed: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """Borders of ranges with about as many rows, from a sample of about twenty rows for each range."""
    total = keyed.count()
    drawn = keyed.sample(min(1.0, 20 * ranges / max(1, total)), seed=7).collect() if total else []
    seen = sorted((r.o, r.h) for r in drawn)
    return sorted({seen[k * len(seen) // ranges] for k in range(1, ranges)}) if seen else []


def _firsts(keyed: DataFrame, cuts: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """The least key of each range that has rows; one row for each range reaches the driver."""
    schema = pa.schema([("place", pa.int64()), ("o", pa.int64()), ("h", pa.int64())])

    def least(batches):
        seen: dict[int, tuple[int, int]] = {}
        for batch in batches:
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = bisect_right(cuts, key)
                seen[place] = min(seen.get(place, key), key)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in (0, 1))], schema=schema)

    found = keyed.mapInArrow(least, "place long, o long, h long").groupBy("place").agg(F.min(F.struct("o", "h")).alias("first"))
    return {r.place: (r.first.o, r.first.h) for r in found.collect()}


def neighbour_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs`` with the columns of the contract, and the exact common beginnings found by binary search.

    The next document follows by ascending id (rows without one first), rows of one id by the hash of their text; the last is
    followed by the first, a single one by itself. Null texts count as empty; repeated rows each give a row. Rows are dealt out
    by ranges of these keys; the first row of each range goes to the range before it too, so that no task needs the whole order.
    Texts are shuffled once.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit(""))
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)))
    rows = docs.select(order.alias("o"), F.xxhash64(body).alias("h"), F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"))
    # Several ranges to a partition, so that hashing them to partitions comes out even.
    cuts = _cuts(rows.select("o", "h"), 4 * n)
    firsts = _firsts(rows.select("o", "h"), cuts)
    places = sorted(firsts)
    before = {place: places[k - 1] for k, place in enumerate(places)}
    schema = pa.schema([("place", pa.int64()), ("extra", pa.bool_()), ("o", pa.int64()), ("h", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string())])

    def deal(batches):
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            own = [bisect_right(cuts, key) for key in keys]
            again = [k for k, (place, key) in enumerate(zip(own, keys)) if firsts[place] == key]
            for take, where, extra in ((None, own, False), (again, [before[own[k]] for k in again], True)):
                if where:
                    columns = batch.columns if take is None else batch.take(pa.array(take)).columns
                    yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array([extra] * len(where)), *columns], schema=schema)

    dealt = rows.mapInArrow(deal, "place long, extra boolean, o long, h long, doc_id long, text string").repartition(n, "place")
    return dealt.sortWithinPartitions("place", "extra", "o", "h").select("place", "extra", "doc_id", "text").mapInArrow(_pairs, SCHEMA)


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
