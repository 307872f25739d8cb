"""Near-duplicate lines: MinHash over character shingles, banding, verification, union-find.

Each task signs a line once, however often it holds it, by fast similarity
sketching: every shingle draws a slot and a value per round, a slot keeps the
least value of its first round, and most lines have all slots after one or two
rounds. Equal lines share an id, a digest of the normalised line; until the
components are known a 64-bit number made from it stands for it, so that joins
and groupings work on whole numbers. Band keys are dealt by key, and those that
two different lines hold make the buckets. Candidate lines are then compared on
their full shingle sets, and one line per component stays.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.bloom import bloom_of
from corvane.llm.components import components
from corvane.llm.near_dedup import link_buckets
from corvane.llm.shingles import chunks, gram_hashes, mixed
from corvane.llm.tables import id_and_text, rows_at_once, ship, written

CHARACTERS = 8
RUN = 1 << 17  # bytes of text signed at a time; arrays of this size stay in the processor's cache
SEEN = 200_000  # lines that a task remembers to have met
ENTRIES = 1 << 15  # keys passed to a task's function at a time
DRAWN = 1 << 20  # values drawn at a time by small sets
PAIRED = 1 << 17  # characters of pairs compared at a time
BANDS, ROWS = 12, 4
_ODD = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")  # white space but spaces and newlines
_BASE = 0x9E3779B97F4A7C15
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def normalised(line: str) -> str:
    """Lower case, white space as single spaces, none at the ends."""
    return " ".join(line.lower().split())


def normalised_lines(text: str) -> list[str]:
    """The normalised lines of a text."""
    if "  " in text or _ODD.search(text):
        return [normalised(line) for line in text.split("\n")]
    return [line.strip(" ") for line in text.lower().split("\n")]


def digest(line: str) -> bytes:
    return hashlib.blake2b(line.encode(), digest_size=16).digest()


def nodes(digests: list[bytes], salt: int) -> np.ndarray:
    """A 64-bit number of each digest, another one for each salt."""
    halves = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return (halves[:, 0] + np.uint64(salt) * halves[:, 1]).view(np.int64)


def sketches(elements: np.ndarray, sizes: np.ndarray, slots: int) -> np.ndarray:
    """One row of ``slots`` values per set; an empty set keeps the largest value in each.

    Fast similarity sketching: in round j each element draws a slot and a value,
    from round ``slots`` on the slot is j - ``slots``. A value holds the round in
    its upper and the random fraction in its lower 32 bits, so later rounds lower
    no filled slot. A set leaves when its slots are filled; rounds go in blocks
    as long as all before them. ``elements`` holds the sets, as spread hashes,
    one after the other, ``sizes`` their lengths.
    """
    found = np.full(len(sizes) * slots, _EMPTY, dtype=np.uint64)
    owners = np.repeat(np.arange(len(sizes)) * slots, sizes)
    done = 0
    while len(elements) and done < 2 * slots:
        until = min(max(2 * done, 1), 2 * slots, done + max(1, DRAWN // len(elements)))
        rounds = np.arange(done, until, dtype=np.uint64)[:, None]
        drawn = mixed(elements + rounds * np.uint64(_BASE)) if done else elements[None, :]
        chosen = drawn >> np.uint64(32)
        chosen *= np.uint64(slots)
        chosen >>= np.uint64(32)
        if until > slots:
            chosen = np.where(rounds < slots, chosen, rounds - np.uint64(slots))
        chosen = chosen.view(np.int64)
        chosen += owners
        values = drawn & np.uint64(0xFFFFFFFF)
        values |= rounds << np.uint64(32)
        np.minimum.at(found, chosen.reshape(-1), values.reshape(-1))
        done = until
        unfilled = (found.reshape(-1, slots) == _EMPTY).any(axis=1)
        going = np.repeat(unfilled, sizes)
        elements, owners, sizes = elements[going], owners[going], sizes * unfilled
    return found.reshape(-1, slots)


def line_keys(sketched: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per set and band of ``rows`` slots."""
    parts = sketched.reshape(len(sketched), bands, rows)
    sums = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sketched), 1))
    for row in range(rows):
        sums += parts[:, :, row] * np.uint64(pow(_BASE, row + 1, 1 << 64))
    return mixed(sums).view(np.int64)


def _signed(texts: DataFrame, width: int, salt: int) -> DataFrame:
    """(doc_id, line_no, line_id, node, keys) of every line; blank lines have a null line_id and node.

    A line has keys where a task meets it first, or again after ``SEEN`` others.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()
    ship(texts.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in source:
            for begin, run in chunks(batch.column(1).to_pylist(), RUN):
                split = [normalised_lines(text.decode()) for text in run]
                counts = np.array([len(lines) for lines in split])
                lines = list(itertools.chain.from_iterable(split))
                ids = [digest(line) if line else None for line in lines]
                full = np.array([each is not None for each in ids])
                numbers = np.zeros(len(ids), dtype=np.int64)
                numbers[full] = nodes([each for each in ids if each], salt)
                fresh = []
                for at, each in enumerate(ids):
                    if each and each not in seen:
                        seen.add(each)
                        fresh.append(at)
                if len(seen) > SEEN:
                    seen.clear()
                grams, sizes = gram_hashes([lines[at] for at in fresh], width)
                keys = line_keys(sketches(grams, sizes, BANDS * ROWS), BANDS, ROWS)
                held = np.zeros(len(ids) + 1, dtype=np.int32)
                held[np.array(fresh, dtype=np.int64) + 1] = 8 * BANDS
                held = np.cumsum(held, dtype=np.int32)
                owners = pa.array(begin + np.repeat(np.arange(len(run)), counts))
                places = np.concatenate([np.arange(count) for count in counts]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(owners),
                        pa.array(places),
                        pa.array(ids, pa.binary()),
                        pa.array(numbers, mask=~full),
                        pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(held), pa.py_buffer(keys)]),
                    ],
                    names=["doc_id", "line_no", "line_id", "node", "keys"],
                )

    return texts.mapInArrow(batches, f"doc_id {kind}, line_no int, line_id binary, node bigint, keys binary")


def _dealt(signed: DataFrame, shares: int) -> DataFrame:
    """(share, keys, numbers) of all entries (key, node); a row holds the entries of one batch in one share of the keys."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint64)
            numbers = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            share = ((keys >> np.uint64(32)) * np.uint64(shares) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(share, kind="stable")
            share, keys, numbers = share[order], keys[order], numbers[order]
            starts = np.flatnonzero(np.diff(share, prepend=-1))
            blocks = [(keys[begin:end].tobytes(), numbers[begin:end].tobytes())
                      for begin, end in itertools.pairwise([*starts.tolist(), len(share)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(share[starts]), *(pa.array([block[at] for block in blocks], pa.binary()) for at in (0, 1))],
                names=["share", "keys", "numbers"],
            )

    entries = signed.select("node", "keys").filter("octet_length(keys) > 0")
    return entries.mapInArrow(batches, "share int, keys binary, numbers binary")


def _buckets(signed: DataFrame) -> DataFrame:
    """(key, doc_id: the node, members: their number) of the keys that several nodes hold.

    The keys are dealt in four shares per partition of a shuffle; a task holds 16 bytes for each entry dealt to it.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch.column(at).to_pylist() for batch in source for at in (1, 2)]
        if not held:
            return
        keys, numbers = (np.frombuffer(b"".join(itertools.chain(*held[at::2])), dtype=np.int64) for at in (0, 1))
        del held
        order = np.argsort(keys)
        again = keys[order[1:]] == keys[order[:-1]]
        order = order[np.append(again, False) | np.insert(again, 0, False)]  # a key that comes once is in no bucket
        keys, numbers = keys[order], numbers[order]
        order = np.lexsort((numbers, keys))
        keys, numbers = keys[order], numbers[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (numbers[1:] != numbers[:-1])
        keys, numbers = keys[fresh], numbers[fresh]
        _, place, members = np.unique(keys, return_inverse=True, return_counts=True)
        members = members[place].astype(np.int64)
        several = members > 1
        whole = pa.RecordBatch.from_arrays(
            [pa.array(column[several]) for column in (keys, numbers, members)], names=["key", "doc_id", "members"]
        )
        for begin in range(0, whole.num_rows, ENTRIES):
            yield whole.slice(begin, ENTRIES)

    shares = 4 * int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _dealt(signed, shares).repartition("share").mapInArrow(batches, "key bigint, doc_id bigint, members bigint")


def _candidate_lines(texts: DataFrame, wanted: DataFrame, salt: int) -> DataFrame:
    """(doc_id: the node, line_id, high: the largest line_id, content: the normalised line) of the nodes in ``wanted``."""
    files = texts.sparkSession.sparkContext.broadcast(bloom_of(wanted, "doc_id"))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in source:
            for _, run in chunks(batch.column(0).to_pylist()):
                lines = {line for text in run for line in normalised_lines(text.decode())}
                lines = list(lines - {""})
                ids = [digest(line) for line in lines]
                numbers = nodes(ids, salt)
                kept = [at for at in np.flatnonzero(files.value.holds(numbers)).tolist() if ids[at] not in seen]
                seen.update(ids[at] for at in kept)
                if len(seen) > SEEN:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers[kept]),
                        pa.array([ids[at] for at in kept], pa.binary()),
                        pa.array([lines[at] for at in kept], pa.string()),
                    ],
                    names=["doc_id", "line_id", "content"],
                )

    found = texts.select("text").mapInArrow(batches, "doc_id bigint, line_id binary, content string")
    found = found.join(wanted.distinct(), "doc_id", "left_semi")
    return found.groupBy("doc_id").agg(
        F.min("line_id").alias("line_id"), F.max("line_id").alias("high"), F.any_value("content").alias("content")
    )


def _compared(own: list[str], other: list[str], width: int) -> tuple[np.ndarray, ...]:
    """n and m, the sizes of the shingle sets of each pair, i of their intersection, and what
    is only in ``own``: the number per pair, and the shingles, sorted within each."""
    count = len(own)
    grams, lengths = gram_hashes([line for pair in zip(own, other, strict=True) for line in pair], width)
    side = np.repeat(np.tile(np.array([0, 1], dtype=np.uint64), count), lengths)
    values = (grams & np.uint64(0xFFFFFFFFFFFFFFFE) | side).view(np.int64)
    lengths = lengths[0::2] + lengths[1::2]
    begin = 0
    for end in np.cumsum(lengths).tolist():
        values[begin:end].sort()
        begin = end
    pair = np.repeat(np.arange(count), lengths)
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (values[1:] != values[:-1]) | (pair[1:] != pair[:-1])
    values, pair = values[fresh], pair[fresh]
    first = values & 1 == 0
    both = np.zeros(len(values), dtype=bool)
    both[:-1] = first[:-1] & (values[:-1] + 1 == values[1:]) & (pair[:-1] == pair[1:])
    only = first & ~both
    sizes = (np.bincount(pair[chosen], minlength=count) for chosen in (first, ~first, both, only))
    return *sizes, values[only]


def _measured_lines(width: int):
    """Compares the shingle sets of two lines, as ``near_dedup.measured_sets`` does for sets."""

    def measure(pairs: DataFrame) -> DataFrame:
        kept = [name for name in pairs.columns if name not in ("own", "other")]

        def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                own, other = batch.column("own").to_pylist(), batch.column("other").to_pylist()
                sizes = np.cumsum([len(a) + len(b) for a, b in zip(own, other, strict=True)])
                begin = 0
                while begin < batch.num_rows:
                    most = PAIRED + (sizes[begin - 1] if begin else 0)
                    end = max(begin + 1, int(np.searchsorted(sizes, most)))
                    *columns, held, rare = _compared(own[begin:end], other[begin:end], width)
                    offsets = np.concatenate(([0], np.cumsum(held))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(name).slice(begin, end - begin) for name in kept),
                            *(pa.array(column, pa.int32()) for column in columns),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare)),
                        ],
                        names=[*kept, "n", "m", "i", "rare"],
                    )
                    begin = end

        passed = ", ".join(f"{name} {pairs.schema[name].dataType.simpleString()}" for name in kept)
        return pairs.mapInArrow(batches, f"{passed}, n int, m int, i int, rare array<bigint>")

    return measure


def _parted(signed: DataFrame, several: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines whose node may be in ``several``, and the others, without their keys."""
    files = signed.sparkSession.sparkContext.broadcast(bloom_of(several, "node"))
    rows = signed.select("doc_id", "line_no", "line_id", "node")

    def part(wanted: bool) -> DataFrame:
        def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                column = batch.column(3)
                held = files.value.holds(column.fill_null(0).to_numpy(zero_copy_only=False))
                held &= column.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(held == wanted))

        return rows.mapInArrow(batches, rows.schema).drop("node")

    return part(True), part(False)


def near_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = CHARACTERS,
    percent: int = 80,
) -> DataFrame:
    """Per line of every text: doc_id, line_no (from 0), line_id, component_id and kept.

    Lines end at newlines. Two lines are linked when the shingle sets of
    ``width`` characters of their normalised forms have an intersection of at
    least ``percent`` percent of their union; ``component_id`` is the smallest
    line id reachable. Of a component the first line by document id and line
    number is kept. Blank lines have null ids and are kept; a null or empty
    text is one blank line. Lines of a null document id come last. Rows that
    share an id and text count as repeats: all their first lines are kept. An
    empty table gives an empty result.
    """
    texts = id_and_text(docs, id_col, text_col)
    for salt in itertools.count():
        signed = written(_signed(texts, width, salt), "lines")
        with rows_at_once(signed.sparkSession, ENTRIES):
            buckets = written(_buckets(signed), "line-buckets")
        lines = written(_candidate_lines(texts, buckets.select("doc_id"), salt), "candidate-lines")
        if lines.filter("line_id <> high").isEmpty():  # else two candidates share a number
            break
    links = link_buckets(buckets, lines.select("doc_id", "content"), percent, _measured_lines(width))
    found = components(links).join(lines.select(F.col("doc_id").alias("node"), "line_id"), "node")
    found = written(found, "line-components")
    least = found.groupBy("component").agg(F.min("line_id").alias("component_id"))
    repeated = signed.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("lines")).filter("lines > 1")
    several, single = _parted(signed, repeated.select("node").unionByName(found.select("node")))
    placed = several.join(found.join(least, "component").select("line_id", "component_id"), "line_id", "left")
    placed = placed.select("doc_id", "line_no", "line_id", F.coalesce("component_id", "line_id").alias("component_id"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line_no")
    firsts = (
        placed.groupBy("component_id")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("lines"))
        .filter("lines > 1")
        .select("component_id", "first")
    )
    kept = (F.col("first").isNull() | (F.col("first") == place)).alias("kept")
    placed = placed.join(firsts, "component_id", "left").select("doc_id", "line_no", "line_id", "component_id", kept)
    alone = single.withColumn("component_id", F.col("line_id")).withColumn("kept", F.lit(True))
    return placed.unionByName(alone)


def keep_first_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, text) with the lines that stay, in their order; blank lines stay.

    Document ids have to be unique.
    """
    gone = near_lines(docs, id_col, text_col, **options).filter("NOT kept")
    gone = gone.groupBy("doc_id").agg(F.collect_list("line_no").alias("gone"))  # at most one document's lines
    lines = F.split("text", r"\n")
    left = F.filter(lines, lambda line, at: F.coalesce(~F.array_contains("gone", at), F.lit(True)))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text")
    return id_and_text(docs, id_col, text_col).join(gone, "doc_id", "left").select("doc_id", text)
