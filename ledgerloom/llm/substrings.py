"""Removal of repeated byte strings by window minima with one split.

This stands in for bucket-pointer refinement, whose rounds over all suffixes need an identifier and an
address for every byte of text: 16 times the input a round. Strings of ``length`` bytes that are equal
must be found wherever they start. Done here in levels:

1. Window minima. Of the q-grams in a string of ``length`` bytes the one with the smallest hash stands
   for it, so neighbouring strings share a q-gram: they form a run, and a run is one row instead of fifty
   strings. Strings can only be equal if their runs are in one bucket.
2. One split. Runs of a bucket with several rows are split by the hash of all bytes their strings reach.
   Runs that agree in it are equal as a whole: settled.
3. Runs whose q-gram is shared but whose reach isn't are the edges of repeats. Only these are compared
   string by string: by the hash of the first ``length / 2`` bytes and of the rest. Settled runs take part
   with one representative.

No identifier is updated or used by a later round. Hashes are 64-bit polynomials, those of two levels must
agree before anything is removed; bytes are never compared.

Null and short texts are kept whole; repeated rows are repeats of each other; matches never cross
documents. An empty table gives an empty result. Of extra columns only the id and the text are read, so
their names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks, utf8
from ledgerloom.session import materialise

LENGTH, GRAM = 200, 64
#: Rows of a file that are one block; a run found again in its block is not sent again.
BLOCK_ROWS = 1024
#: Bytes worked on at once, and runs compared at once.
PIECE, COMPARED = 1 << 20, 1 << 15
#: Runs of a bucket beyond which its suffixes are compared by a shuffle of their own.
HOT = 1 << 16
_U = np.uint64
_LOW = _U((1 << 22) - 1)

RUNS = "block long, gram long, run long, n long"
CUTS = """file long, row long, doc_id long, n_bytes long, n_removed long, n_spans long,
kept_sha256 string, text binary, spans binary, gram long, run long, start int, size int,
weight int"""


@lru_cache(1)
def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random word for each byte, and the powers of an odd base and of its inverse."""
    rng = np.random.default_rng(20)
    words = rng.integers(0, 2**64, 256, dtype=np.uint64) | _U(1)
    base = int(rng.integers(1, 2**63)) | 1
    powers = []
    for b in (base, pow(base, -1, 2**64)):
        power = np.full(2 * PIECE + 2 * LENGTH, b, np.uint64)
        power[0] = 1
        powers.append(np.multiply.accumulate(power))
    return words, *powers


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    padded = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(h)] = h
    padded = padded.reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: len(h) - width + 1], before[width - 1 : len(h)])


def _sums(data: np.ndarray) -> np.ndarray:
    words, power, _ = _constants()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(words[data] * power[: len(data)], out=sums[1:])
    return sums


def find_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple:
    """Runs of suffixes that share their smallest q-gram, in texts that end at ``ends``.

    Returns first and last suffix, bucket of the q-gram, and bucket of all bytes the run reaches.
    A suffix with less than ``length`` bytes to its text's end is in no run.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    inverse = _constants()[2]
    sums = _sums(data)
    bucket = _mix((sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1])
    keyed = (bucket & ~_LOW) | np.arange(len(bucket), dtype=np.uint64)
    place = (_sliding_min(keyed, length - gram + 1) & _LOW).astype(np.int32)
    n = len(place)
    limit = np.repeat(ends, np.diff(ends, prepend=0))[:n]
    valid = np.arange(n) + length <= limit
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1]) | (limit[1:] != limit[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    at = place[first]
    reach = (sums[last + length] - sums[first]) * inverse[first]
    shape = ((last - first).astype(np.uint64) << _U(32)) | (at - first).astype(np.uint64)
    return first, last, bucket[at], _mix(reach ^ _mix(shape ^ bucket[at]))


def _pieces(texts: list[bytes | None], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts put together into arrays of about PIECE bytes; a longer text goes on in the next.

    Yields bytes, the end of each text, its number, and the offset of its part in the text.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def joined():
        data = np.frombuffer(b"".join(h[2] for h in held), np.uint8)
        ends = np.cumsum([len(h[2]) for h in held])
        return data, ends, np.array([h[0] for h in held]), np.array([h[1] for h in held])

    for i, text in enumerate(texts):
        if text is None or len(text) < length:
            continue
        for offset in range(0, len(text) - length + 1, PIECE):
            part = text[offset : offset + PIECE + length - 1]
            if held and size + len(part) > PIECE:
                yield joined()
                held, size = [], 0
            held.append((i, offset, part))
            size += len(part)
    if held:
        yield joined()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _runs_of_blocks(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        current = None

        def flush() -> pa.RecordBatch:
            grams, runs = (np.concatenate(x) for x in zip(*seen, strict=True))
            runs, at, n = np.unique(runs, return_index=True, return_counts=True)
            columns = [pa.array(np.full(len(runs), current, np.int64)), _signed(grams[at])]
            columns += [_signed(runs), pa.array(n.astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, ["block", "gram", "run", "n"])

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cut = np.flatnonzero(np.diff(blocks)) + 1
            for a, b in zip([0, *cut], [*cut, len(blocks)], strict=True):
                if b > a and blocks[a] != current:
                    if seen:
                        yield flush()
                    seen, current = [], int(blocks[a])
                for part in chunks(iter([batch.slice(a, b - a)]), "text"):
                    for data, ends, _, _ in _pieces(part.column("text").to_pylist(), length):
                        seen.append(find_runs(data, ends, length, gram)[2:])
        if seen:
            yield flush()

    return run


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal ranges covered by ranges; touching ones are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])[: len(starts)]
    first = np.flatnonzero(new)
    return starts[first], reach[np.append(first[1:], len(starts)) - 1] if len(first) else reach


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, ranges removed, digest of the rest."""
    starts, ends = _spans(starts, ends)
    digest, at = hashlib.sha256(), 0
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        digest.update(text[at:a])
        at = b
    digest.update(text[at:])
    return int((ends - starts).sum()), len(starts), digest.hexdigest()


_EMPTY = {name: None for name in (x.split()[0] for x in CUTS.split(","))}


def _cut_blocks(length: int, gram: int):
    """From a block's flagged runs, then its documents: results, or what is still to be decided.

    ``state`` of a run: 1 settled, 2 to be refined, 3 settled and a representative. A document
    whose runs are all settled is finished; another goes on with its text and settled ranges. Runs
    of state 2 and 3 go on with the bytes that they reach.
    """
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in (x.split() for x in CUTS.split(","))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known, state = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        sent: set[int] = set()
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        for big in batches:
            for batch in chunks(iter([big]), "text"):
                blocks = batch.column("block").to_numpy()
                kinds = batch.column("state").to_numpy()
                cut = np.flatnonzero((np.diff(blocks) != 0) | ((kinds[1:] > 0) != (kinds[:-1] > 0))) + 1
                rows: list[dict] = []
                for a, b in zip([0, *cut], [*cut, len(blocks)], strict=True):
                    if b <= a:
                        continue
                    if blocks[a] != block:
                        block, pending, sent = blocks[a], [], set()
                        known, state = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                    if kinds[a]:
                        runs = batch.column("run").slice(a, b - a).to_numpy().view(np.uint64)
                        pending.append((runs, kinds[a:b]))
                        continue
                    if pending:
                        runs = np.concatenate([known, *(p[0] for p in pending)])
                        order = np.argsort(runs)
                        state = np.concatenate([state, *(p[1] for p in pending)])[order]
                        known, pending = runs[order], []
                    rows += documents(batch.slice(a, b - a), known, state, sent)
                yield pa.RecordBatch.from_pylist(rows, schema)

    def documents(batch: pa.RecordBatch, known: np.ndarray, state: np.ndarray, sent: set) -> list[dict]:
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        files, places, ids = (batch.column(c).to_pylist() for c in ("file", "row", "doc_id"))
        ranges: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        edges: set[int] = set()
        rows = []
        for data, ends, owner, offset in _pieces(texts, length) if len(known) else ():
            first, last, grams, runs = find_runs(data, ends, length, gram)
            at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
            kind = np.where(known[at] == runs, state[at], 0)
            text = np.searchsorted(ends, first, "right")
            shift = offset[text] - np.append(0, ends[:-1])[text]
            found = np.flatnonzero((kind == 1) | (kind == 3))
            for i in np.split(found, np.flatnonzero(np.diff(text[found])) + 1) if len(found) else ():
                ranges.setdefault(int(owner[text[i[0]]]), []).append(
                    (first[i] + shift[i], last[i] + shift[i] + length)
                )
            for i in np.flatnonzero(kind >= 2).tolist():
                doc, size = int(owner[text[i]]), int(last[i] - first[i])
                if kind[i] == 2:
                    edges.add(doc)
                elif int(runs[i]) in sent:
                    continue
                sent.add(int(runs[i]))
                rows.append(_EMPTY | {
                    "file": files[doc], "row": places[doc], "gram": int(grams[i].view(np.int64)),
                    "run": int(runs[i].view(np.int64)), "start": int(first[i] + shift[i]),
                    "size": size + 1, "weight": 1 if kind[i] == 2 else 2,
                    "text": data[first[i] : last[i] + length].tobytes(),
                })
        none = np.zeros(0, np.int64)
        for i, t in enumerate(texts):
            starts, stops = (np.concatenate(x) for x in zip(*ranges.get(i, [(none, none)]), strict=True))
            row = _EMPTY | {"file": files[i], "row": places[i], "doc_id": ids[i], "n_bytes": len(t)}
            if i in edges:
                starts, stops = _spans(starts, stops)
                rows.append(row | {"text": t, "spans": np.stack([starts, stops]).astype(np.int64).tobytes()})
            else:
                n_removed, n_spans, digest = _cut(t, starts, stops)
                rows.append(row | {"n_removed": n_removed, "n_spans": n_spans, "kept_sha256": digest})
        return rows

    return run


def _suffix_buckets(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix of each run: the run's number and the identifiers of both halves."""
    inverse, half = _constants()[2], length // 2
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    sums = _sums(data)
    owner = np.repeat(np.arange(len(texts)), sizes - length + 1)
    at = np.arange(len(owner)) + owner * (length - 1)
    one = (sums[at + half] - sums[at]) * inverse[at]
    two = (sums[at + length] - sums[at + half]) * inverse[at + half]
    return owner, _mix(one), _mix(two ^ _U(length))


def _refined(length: int):
    """Of rows sorted by bucket: the suffixes of runs of weight 1 that are in a bucket of two."""

    def decide(batch: pa.Table) -> pa.RecordBatch | None:
        rows = {c: batch.column(c).to_pylist() for c in ("file", "row", "gram", "start", "weight", "text")}
        gram = _mix(np.array(rows["gram"], np.int64).view(np.uint64))
        weight = np.array(rows["weight"], np.int64)
        out = []
        step = max(1, PIECE // max(len(t) for t in rows["text"]))
        parts = [_suffix_buckets(rows["text"][i : i + step], length) for i in range(0, len(gram), step)]
        owner = np.concatenate([p[0] + i * step for i, p in enumerate(parts)])
        key = np.concatenate([_mix(p[1] + _mix(p[2])) for p in parts]) ^ gram[owner]
        order = np.argsort(key)
        new = np.append(True, key[order][1:] != key[order][:-1])
        group = np.cumsum(new) - 1
        total = np.bincount(group, weights=weight[owner[order]])
        found = np.sort(order[(total[group] > 1) & (weight[owner[order]] == 1)])
        if not len(found):
            return None
        base = np.append(0, np.cumsum(np.bincount(owner, minlength=len(gram))))[owner[found]]
        starts = np.array(rows["start"], np.int64)[owner[found]] + found - base
        new = np.append(True, (np.diff(owner[found]) != 0) | (np.diff(found) != 1))
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(found)) - 1
        at = owner[found[a]]
        out = [np.array(rows[c], np.int64)[at] for c in ("file", "row")]
        out += [starts[a].astype(np.int64), (starts[b] + length).astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["file", "row", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        n = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            n += batch.num_rows
            if n < COMPARED:
                continue
            whole = pa.concat_tables(held)
            grams = whole.column("gram").to_numpy()
            done = int(np.searchsorted(grams, grams[-1]))  # the last bucket may go on
            if done:
                if (found := decide(whole.slice(0, done))) is not None:
                    yield found
                held = [whole.slice(done)]
                n = whole.num_rows - done
        if n and (found := decide(pa.concat_tables(held))) is not None:
            yield found

    return run


def _hot(edges: DataFrame, length: int) -> DataFrame:
    """What ``_refined`` gives, for buckets of any size: suffixes are counted by a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", PIECE):
            owner, one, two = _suffix_buckets(batch.column("text").to_pylist(), length)
            first = np.append(True, np.diff(owner) != 0) if len(owner) else np.zeros(0, bool)
            place = np.arange(len(owner)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            taken = [batch.column(c).to_numpy()[owner] for c in ("file", "row", "start", "weight")]
            columns = [taken[0], taken[1], (taken[2] + place).astype(np.int64), taken[3].astype(np.int64)]
            columns += [one.view(np.int64), two.view(np.int64)]
            names = ["file", "row", "start", "weight", "one", "two"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    schema = "file long, row long, start long, weight long, one long, two long"
    suffixes = materialise(edges.mapInArrow(run, schema), "suffixes")
    many = suffixes.groupBy("one", "two").agg(F.sum("weight").alias("n")).where("n > 1").drop("n")
    found = suffixes.where("weight = 1").join(many, ["one", "two"], "left_semi")
    return found.select("file", "row", "start", (F.col("start") + length).alias("end"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in chunks(batches, "text"):
        columns: list[list] = [[], [], [], [], []]
        rows = (batch.column(c).to_pylist() for c in ("doc_id", "text", "spans", "starts", "ends"))
        for doc_id, text, spans, starts, ends in zip(*rows, strict=True):
            settled = np.frombuffer(spans, np.int64).reshape(2, -1)
            starts = np.append(settled[0], np.array(starts or [], np.int64))
            ends = np.append(settled[1], np.array(ends or [], np.int64))
            for c, x in zip(columns, (doc_id, len(text), *_cut(text, starts, ends)), strict=True):
                c.append(x)
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )


def with_address(docs: DataFrame) -> DataFrame:
    """doc_id, bytes of the text, and the file and row each stands at, which name it for good.

    Rows that don't come straight from files are written to the shared folder first.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    try:
        rows = docs.select("*", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        rows = materialise(docs, "texts").select("*", "_metadata.file_path", "_metadata.row_index")
    file = F.xxhash64("file_path")
    return rows.select(
        "doc_id", utf8(F.col("text")).alias("text"), file.alias("file"), F.col("row_index").alias("row"),
        F.xxhash64(file, F.floor(F.col("row_index") / BLOCK_ROWS)).alias("block"),
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per document: its bytes, those removed, the removed ranges, digest of the rest.

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too.
    """
    if not 1 <= gram <= length:
        raise ValueError("a q-gram has 1 to length bytes")
    rows = with_address(docs)
    runs = rows.select("block", "text").mapInArrow(_runs_of_blocks(length, gram), RUNS)
    runs = materialise(runs, "runs")
    shared = runs.groupBy("gram").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_rows"),
        (F.min("run") != F.max("run")).alias("mixed"),
    )
    shared = materialise(shared.where("n > 1").select("gram", "mixed", "n_rows"), "shared")
    flagged = materialise(runs.join(shared, "gram"), "flagged")
    # In mixed buckets: runs found once are to be refined, others send one representative.
    mixed = flagged.where("mixed").groupBy("gram", "run").agg(
        F.sum("n").alias("total"), F.min("block").alias("sender"), F.max("n_rows").alias("n_rows")
    )
    mixed = materialise(mixed, "mixed")
    known = flagged.where("NOT mixed").select("block", "run", F.lit(1).alias("state"))
    state = F.when(F.col("total") == 1, 2).when(F.col("sender") == F.col("block"), 3).otherwise(1)
    split = flagged.where("mixed").select("gram", "run", "block").join(mixed, ["gram", "run"])
    known = known.unionByName(split.select("block", "run", state.alias("state")))
    lines = known.select(
        "block", "run", "state", F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("text"), F.lit(0).cast("long").alias("file"),
        F.lit(0).cast("long").alias("row"),
    ).unionByName(rows.withColumns({"run": F.lit(0).cast("long"), "state": F.lit(0)}))
    lines = lines.repartition("block").sortWithinPartitions("block", F.desc("state"))
    cuts = materialise(lines.mapInArrow(_cut_blocks(length, gram), CUTS), "cuts")

    edges = cuts.where("gram IS NOT NULL").select("file", "row", "gram", "run", "start", "weight", "text")
    crowded = mixed.where(F.col("n_rows") > hot).select("gram").distinct()
    usual = edges.join(crowded, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    found = usual.drop("run").mapInArrow(_refined(length), "file long, row long, start long, end long")
    found = found.unionByName(_hot(edges.join(crowded, "gram", "left_semi"), length))
    found = found.groupBy("file", "row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("found")
    )
    waiting = cuts.where("spans IS NOT NULL").select("file", "row", "doc_id", "text", "spans")
    late = waiting.join(found, ["file", "row"], "left").select(
        "doc_id", "text", "spans", F.col("found.start").alias("starts"), F.col("found.end").alias("ends")
    )
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    done = cuts.where("kept_sha256 IS NOT NULL").select(*columns)
    return done.unionByName(late.mapInArrow(_finish, schema))
