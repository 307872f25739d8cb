"""Word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORD_BREAKS = bytes([0x20, *range(0x09, 0x0E)])  # bytes.split() breaks at exactly these
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(WORD_BREAKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse up to ``size``; short tables are kept."""
    global _powers
    if size <= len(_powers[0]):
        return _powers[0][:size], _powers[1][:size]
    tables = []
    for base in (_BASE, _INVERSE):
        table = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    if size <= 1 << 22:
        _powers = tables[0], tables[1]
    return tables[0][:size], tables[1][:size]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the number of words of each text.

    Words are runs of bytes without ASCII white space; A-Z count as a-z.
    """
    joined = b" ".join([*texts, b""])
    data = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[0::2], edges[1::2]
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * down[starts]
    ends = np.cumsum([len(text) + 1 for text in texts])
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, ends)))).astype(np.int64)
    return mixed(hashes), counts


def gram_hashes(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` characters of the lines in order, repeats
    included, and their number per line.

    A line of fewer characters is one run; an empty line has none. Runs of twice
    the length are made from neighbouring ones, up to the width.
    """
    # A lone surrogate stands in no text, so a filled line equals no other run.
    filled = [line.ljust(width, "\ud800") if line else line for line in lines]
    lengths = np.array([len(line) for line in filled], dtype=np.int64)
    sizes = np.maximum(lengths - width + 1, 0)
    if not lengths.sum():
        return np.zeros(0, np.uint64), sizes
    data = np.frombuffer("".join(filled).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    wide, have = data, 1
    for bit in f"{width:b}"[1:]:
        wide = wide[:-have] * np.uint64(pow(int(_BASE), have, 1 << 64)) + wide[have:]
        have *= 2
        if bit == "1":
            wide = wide[:-1] * _BASE + data[have:]
            have += 1
    within = np.ones(len(data), dtype=bool)
    ends = np.cumsum(lengths[lengths > 0])
    for back in range(1, width):
        within[ends - back] = False
    return mixed(wide[within[: len(wide)]]), sizes


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of ``width`` words of each text, as hashes.

    A text of fewer words has one shingle, its whole sequence; one without
    words has none.
    """
    hashes, counts = word_hashes(texts)
    length = max(len(hashes) - width + 1, 0)
    wide = np.zeros(length, dtype=np.uint64)
    for at in range(width):
        wide = (wide + hashes[at : at + length]) * _BASE + np.uint64(at)
    wide = mixed(wide)
    sets, begin = [], 0
    for count in counts.tolist():
        if count >= width:
            sets.append(np.unique(wide[begin : begin + count - width + 1]))
        elif count:
            whole = np.uint64(count)
            with np.errstate(over="ignore"):
                for value in hashes[begin : begin + count]:
                    whole = (whole + value) * _INVERSE + np.uint64(7)
            sets.append(mixed(np.array([whole], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
        begin += count
    return sets


def chunks(texts: list[str | None], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes, in runs of about ``most`` bytes, each with its start index."""
    begin, run, size = 0, [], 0
    for at, text in enumerate(texts):
        data = (text or "").encode()
        if run and size + len(data) > most:
            yield begin, run
            begin, run, size = at, [], 0
        run.append(data)
        size += len(data)
    if run:
        yield begin, run
