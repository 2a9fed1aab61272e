"""What tasks do with the letters of reads: k-mers as numbers, counted or compared before rows leave a task."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: k-mers that are counted at once: 128 MB of numbers.
AT_ONCE = 1 << 24
#: Places of k-mers that are dealt into parts at once, and letters that are turned into k-mers at once, some 40 bytes each.
PLACES_AT_ONCE = 1 << 22
LETTERS_AT_ONCE = 1 << 20
_TWO_BITS = np.full(256, 255, "u1")
_TWO_BITS[np.frombuffer(b"acgt", "u1")] = np.arange(4)
_DIGITS = str.maketrans("acgt", "0123")


def packed_kmers(texts: pa.Array, k: int) -> tuple[np.ndarray, list[str]]:
    """All k-mers of texts of a, c, g and t as numbers, two bits a letter; and the texts that hold anything else."""
    data = "".join(texts.to_pylist()).encode()
    size = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype("i8")
    ends = np.cumsum(size)
    two = _TWO_BITS[np.frombuffer(data, "u1")]
    odd = np.unique(np.searchsorted(ends, np.flatnonzero(two == 255), "right")) if k <= 31 else np.arange(len(texts))
    other = [texts[int(i)].as_py() for i in odd]
    if len(two) < k or len(odd) == len(texts):
        return np.zeros(0, "i8"), other
    # A k-mer is put together from stretches of 1, 2, 4, ... letters.
    run, done, out, at = two.astype("i8"), 1, None, 0
    n = len(two) - k + 1
    while True:
        if k & done:
            part = run[at : at + n]
            out, at = part.copy() if out is None else (out << (2 * done)) | part, at + done
        if 2 * done > k:
            break
        run, done = (run[:-done] << (2 * done)) | run[done:], 2 * done
    keep = np.ones(n, bool)
    for i in range(1, k):
        crossing = ends - i
        keep[crossing[(crossing >= 0) & (crossing < n)]] = False
    for i in odd:
        keep[max(0, int(ends[i] - size[i])) : max(0, int(ends[i]))] = False
    return out[keep], other


def count_kmers(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (code, kmer, n) of texts in a column ``_s``: ``code`` of k-mers of a, c, g and t, ``kmer`` of others; several rows of one k-mer may come."""

    def rows(codes: list[np.ndarray], others: Counter) -> pa.RecordBatch:
        code, n = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, "i8"), np.zeros(0, "i8"))
        # A text with other letters has k-mers without them too.
        plain = [m for m in others if k <= 31 and set(m) <= set("acgt")]
        if plain:
            code = np.concatenate([code, np.array([int(m.translate(_DIGITS), 4) for m in plain], "i8")])
            n = np.concatenate([n, np.array([others.pop(m) for m in plain], "i8")])
        gap = len(code)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(code, pa.int64()), pa.nulls(len(others), pa.int64())]), pa.concat_arrays([pa.nulls(gap, pa.string()), pa.array(list(others), pa.string())]), pa.array([*n.tolist(), *others.values()] if others else n, pa.int64())],
            ["code", "kmer", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, others, held = [], Counter(), 0
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                code, other = packed_kmers(b.column("_s").slice(i, 2048), k)
                codes.append(code)
                for s in other:
                    others.update(s[j : j + k] for j in range(len(s) - k + 1))
                held += len(code)
                if held + len(others) >= AT_ONCE:
                    yield rows(codes, others)
                    codes, others, held = [], Counter(), 0
        yield rows(codes, others)

    return run


def repeated_triplets(w: int, t: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """rid, win of windows (``_s``: their letters, ``_c``: the first one's number) whose triplets repeat: sum of c (c - 1) / 2 over ``t`` times w - 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid, win = [], []
            for r, c, s in zip(b.column("rid").to_pylist(), b.column("_c").to_pylist(), b.column("_s").to_pylist(), strict=True):
                x = np.frombuffer(s.encode("utf-32-le"), "u4").astype("i8")
                if len(x) < 3:
                    continue
                tri = (x[:-2] << 42) | (x[1:-1] << 21) | x[2:]
                # Windows side by side; where one has no triplet there is a number of its own.
                full = -(-len(tri) // w)
                grid = -1 - np.arange(full * w)
                grid[: len(tri)] = tri
                grid = np.sort(grid.reshape(full, w)[:, : w - 2], axis=1)
                same = np.zeros((full, w - 2), "i8")
                for j in range(1, w - 2):
                    same[:, j] = np.where(grid[:, j] == grid[:, j - 1], same[:, j - 1] + 1, 0)
                hit = np.flatnonzero(same.sum(axis=1) > t * (w - 3))
                rid += [r] * len(hit)
                win += (c + hit).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rid, b.column("rid").type), pa.array(win, pa.int64())], ["rid", "win"])

    return run


def kmer_codes(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """code, text and place (from 0) of each k-mer of a, c, g and t, two bits a letter; ``k`` is 31 at most. Null texts have none."""
    strings = [s or "" for s in texts.to_pylist()]
    # One byte a letter, and one between texts, which no k-mer goes over.
    data = "\n".join(strings).encode("latin-1", "replace")
    two = _TWO_BITS[np.frombuffer(data, "u1")]
    n = len(two) - k + 1
    if n <= 0:
        return np.zeros(0, "i8"), np.zeros(0, "i4"), np.zeros(0, "i4")
    bad = np.zeros(len(two) + 1, "i4")
    np.cumsum(two == 255, out=bad[1:])
    run, done, out, at = (two & 3).astype("i8"), 1, None, 0
    while True:
        if k & done:
            part = run[at : at + n]
            out, at = part.copy() if out is None else (out << (2 * done)) | part, at + done
        if 2 * done > k:
            break
        run, done = (run[:-done] << (2 * done)) | run[done:], 2 * done
    whole = np.flatnonzero(bad[k:] == bad[:-k])
    size = np.fromiter(map(len, strings), "i8", len(strings)) + 1
    begins = np.cumsum(size) - size
    text = np.repeat(np.arange(len(strings), dtype="i4"), size)[whole]
    return out[whole], text, (whole - begins[text]).astype("i4")


def rank_in_runs(sorted_: np.ndarray) -> np.ndarray:
    """The number (from 0) of each entry among its equals."""
    new = np.ones(len(sorted_), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    at = np.flatnonzero(new)
    return np.arange(len(sorted_)) - np.repeat(at, np.diff(np.append(at, len(sorted_))))


def least_inside(code: np.ndarray, k: int, m: int) -> np.ndarray:
    """Of each k-mer the least m-mer in it, by a mixed number: neighbours in a text often have the same."""
    out = np.full(len(code), 2**64 - 1, "u8")
    for j in range(k - m + 1):
        x = (code.view("u8") >> np.uint64(2 * j)) & np.uint64(4**m - 1)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(out, x, out=out)
    return out


def send_places(k: int, chunk: int, below: int, parts: int, together: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (part, code, off, rid, pos, n, strand) of chunks (rid, _c, _s, strand): all k-mers of one part of their numbers, packed.

    ``code`` and ``off`` hold a number for each place, ``rid``, ``pos`` and ``n`` one for each stretch: its read, where it begins, and how many places
    of it follow. No more than ``below`` places of a k-mer are sent at once: that is enough to tell that it occurs as often.
    ``together``: neighbours in a text often go to the same part, so that what two reads share meets there many times; parts are a little less even.
    """
    wide = "<u4" if k <= 16 else "<i8"

    def rows(got: list[tuple], strand: int) -> pa.RecordBatch:
        rid, first = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        sizes = np.cumsum([0] + [len(g[0]) for g in got])
        code = np.concatenate([g[2] for g in got])
        text = np.concatenate([g[3] + np.int32(s) for g, s in zip(got, sizes, strict=False)])
        off = np.concatenate([g[4] for g in got]).astype("<u2")
        got.clear()
        part = (least_inside(code, k, max(1, k - 3)) if together else code.view("u8")) * np.uint64(0x9E3779B97F4A7C15)
        part >>= np.uint64(40)
        part %= np.uint64(parts)
        part = part.astype("u2" if parts < 65_536 else "u4")
        order = np.argsort(part, kind="stable").astype("i4")
        ends = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
        del part
        out = []
        for p in np.flatnonzero(np.diff(ends)):
            i = order[ends[p] : ends[p + 1]]
            by = np.argsort(code[i], kind="stable")
            few = np.zeros(len(i), bool)
            few[by] = rank_in_runs(code[i][by]) < below
            i = i[few]
            t = text[i]
            new = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            of = t[new]
            out.append((int(p), code[i].astype(wide).tobytes(), off[i].tobytes(), rid[of].tobytes(), first[of].tobytes(), np.diff(np.append(new, len(i))).astype("<u2").tobytes(), strand))
        kinds = [pa.int32(), *[pa.binary()] * 5, pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 7, kinds, strict=True)], ["part", "code", "off", "rid", "pos", "n", "strand"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, held = {0: [], 1: []}, {0: 0, 1: 0}
        for b in batches:
            # Stretches are of any length; no more letters than a few stretches hold are taken at once.
            at = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(b.column("_s")), 0).to_numpy(zero_copy_only=False).astype("i8")) // LETTERS_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), b.num_rows]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                some = b.slice(i, j - i)
                strands = some.column("strand").to_numpy(zero_copy_only=False)
                for s in np.unique(strands).tolist():
                    x = some.filter(pa.array(strands == s))
                    code, text, off = kmer_codes(x.column("_s"), k)
                    got[s].append((x.column("rid").to_numpy(zero_copy_only=False), x.column("_c").to_numpy(zero_copy_only=False).astype("i8") * chunk, code, text, off))
                    held[s] += len(code)
                    if held[s] >= PLACES_AT_ONCE:
                        yield rows(got[s], s)
                        got[s], held[s] = [], 0
        for s in got:
            if held[s]:
                yield rows(got[s], s)

    assert chunk < 65_536
    return run


def unpack_places(batches: Iterator[pa.RecordBatch], k: int) -> tuple[np.ndarray, ...]:
    """code, rid, pos (from 1) and strand of all places in the rows that ``send_places`` made, in the order of code, strand, rid and pos."""
    wide = "<u4" if k <= 16 else "<i8"
    cols = [[np.zeros(0, t)] for t in (wide, "<i8", "<i8", "u1")]
    for b in batches:
        for code, off, rid, pos, n, strand in zip(*(b.column(c).to_pylist() for c in ("code", "off", "rid", "pos", "n", "strand")), strict=True):
            n, code = np.frombuffer(n, "<u2"), np.frombuffer(code, wide)
            cols[0].append(code)
            cols[1].append(np.repeat(np.frombuffer(rid, "<i8"), n))
            cols[2].append(np.repeat(np.frombuffer(pos, "<i8"), n) + np.frombuffer(off, "<u2") + 1)
            cols[3].append(np.full(len(code), strand, "u1"))
    code, rid, pos, strand = (np.concatenate(c) for c in cols)
    del cols
    order = np.argsort(code, kind="stable")
    return code[order], rid[order], pos[order], strand[order]


def runs_below(key: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Which entries of a sorted array occur less than ``below`` times, and how often."""
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    size = np.diff(np.append(new, len(key)))
    each = np.repeat(size, size)
    few = each < below
    return few, each[few]


def few_places(k: int, below: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (rid, pos, code, n) of the places of k-mers that occur less than ``below`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, rid, pos, _ = unpack_places(batches, k)
        few, n = runs_below(code, below)
        code, rid, pos = code[few], rid[few], pos[few]
        for i in range(0, len(code), 1 << 18):
            j = slice(i, i + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array(c[j].astype("i8")) for c in (rid, pos, code, n)], ["rid", "pos", "code", "n"])

    return run


def meet_places(k: int, below: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (aread, bread, comp, apos, bpos), aread < bread, of places that share a k-mer which occurs less than ``below`` times on the strand of each.

    a's place is on strand 0, b's on strand ``comp``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, rid, pos, strand = unpack_places(batches, k)
        key = (code.astype("i8") << 1) | strand
        order = np.argsort(key, kind="stable")
        order = order[runs_below(key[order], below)[0]]
        code, rid, pos, strand = code[order], rid[order], pos[order], strand[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]]))
        size = np.diff(np.append(new, len(code)))
        # Each place of strand 0 meets all of its k-mer, some places at a time.
        at = np.flatnonzero(strand == 0)
        group = np.repeat(np.arange(len(size)), size)[at]
        begin, many = new[group], size[group]
        step = np.cumsum(many)
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(step, (step[i - 1] if i else 0) + (1 << 18), "right")))
            m = many[i:j]
            a = np.repeat(at[i:j], m)
            b = np.repeat(begin[i:j], m) + np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m)
            ok = rid[a] < rid[b]
            a, b = a[ok], b[ok]
            yield pa.RecordBatch.from_arrays([pa.array(rid[a]), pa.array(rid[b]), pa.array(strand[b].astype("i4")), pa.array(pos[a]), pa.array(pos[b])], ["aread", "bread", "comp", "apos", "bpos"])
            i = j

    return run


def self_bands(k: int, w: int, h: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (rid, band, score, amin, amax, total) of reads (rid, _s: its texts), see ``self_seed_hits``."""

    def numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if k <= 31:
            code, _, off = kmer_codes(texts, k)
        else:
            code, off = np.zeros(0, "i8"), np.zeros(0, "i4")
        if k <= 31 and len(code) == sum(max(0, len(s or "") - k + 1) for s in texts.to_pylist()):
            return code, off
        # Other letters: k-mers by name, in numbers that no k-mer of a, c, g and t has.
        name: dict[str, int] = {}
        rows = [(-1 - name.setdefault(s[i : i + k], len(name)), i) for s in texts.to_pylist() if s for i in range(len(s) - k + 1) if k > 31 or not set(s[i : i + k]) <= set("acgt")]
        return np.concatenate([code, np.array([r[0] for r in rows], "i8")]), np.concatenate([off, np.array([r[1] for r in rows], "i4")])

    def bands(texts: pa.Array) -> tuple[np.ndarray, ...]:
        code, pos = numbers(texts)
        order = np.lexsort((pos, code))
        code, pos = code[order], pos[order].astype("i8") + 1
        again = np.flatnonzero(code[1:] == code[:-1]) + 1
        at, band = pos[again], (pos[again] - pos[again - 1]) >> w
        order = np.lexsort((at, band))
        at, band = at[order], band[order]
        new = np.concatenate([np.ones(min(1, len(band)), bool), band[1:] != band[:-1]])
        gain = np.full(len(at), k, "i8")
        gain[1:] = np.where(new[1:], k, np.minimum(k, at[1:] - at[:-1]))
        first = np.flatnonzero(new)
        if not len(first):
            return (np.zeros(0, "i8"),) * 5
        score, band, amin, amax = np.add.reduceat(gain, first), band[first], at[first], at[np.append(first[1:], len(at)) - 1]
        total = score.copy()
        total[:-1] += np.where(band[1:] == band[:-1] + 1, score[1:], 0)
        hit = total >= h
        return band[hit], score[hit], amin[hit], amax[hit], total[hit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, kind = b.column("_s"), b.column("rid").type
            for i in range(0, b.num_rows, 256):
                found = [bands(texts[j].values) for j in range(i, min(i + 256, b.num_rows))]
                rid = b.column("rid").slice(i, 256).take(pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found])))
                yield pa.RecordBatch.from_arrays([rid.cast(kind), *(pa.array(np.concatenate(c)) for c in zip(*found, strict=True))], ["rid", "band", "score", "amin", "amax", "total"])

    return run


#: Votes that are counted at once, if they hold whole tiles.
VOTES = 1 << 16


def vote_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (aread, tile, seq, used) of votes (aread, tile, piece, own) that come sorted by tile, see ``column_consensus``; no piece is empty."""

    def letters(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All letters, where each piece begins in them, and how many it has."""
        texts = pieces.to_pylist()
        size = np.fromiter(map(len, texts), "i8", len(texts))
        text = "".join(texts)
        data = np.frombuffer(text.encode(), "u1") if text.isascii() else np.frombuffer(text.encode("utf-32-le"), "u4")
        return data, np.cumsum(size) - size, size

    def chosen(group: np.ndarray, size: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The length of each group: the most frequent, of equals that of A's own piece, then the shorter."""
        order = np.lexsort((size, group))
        new = np.flatnonzero(np.concatenate([[True], (group[order][1:] != group[order][:-1]) | (size[order][1:] != size[order][:-1])]))
        g, s = group[order][new], size[order][new]
        many, mine = np.diff(np.append(new, len(order))), np.maximum.reduceat(own[order], new)
        best = np.lexsort((s, -mine, -many, g))
        return s[best][np.concatenate([[True], g[best][1:] != g[best][:-1]])]

    def vote(rows: pa.Table) -> pa.RecordBatch:
        aread, tile = rows.column("aread").to_numpy(), rows.column("tile").to_numpy()
        own = rows.column("own").to_numpy().astype("i8")
        first = np.flatnonzero(np.concatenate([[True], (aread[1:] != aread[:-1]) | (tile[1:] != tile[:-1])]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(aread))))
        data, at, size = letters(rows.column("piece").combine_chunks())
        length = chosen(group, size, own)
        seq, used = np.empty(len(first), object), np.zeros(len(first), "i8")
        votes = np.flatnonzero(size == length[group])
        votes = votes[np.argsort(size[votes], kind="stable")]
        ends = np.concatenate([[0], np.flatnonzero(np.diff(size[votes])) + 1, [len(votes)]])
        for i, j in zip(ends[:-1], ends[1:], strict=True):
            r, n = votes[i:j], int(size[votes[i]])
            m = data[at[r][:, None] + np.arange(n)]
            begin = np.flatnonzero(np.concatenate([[True], group[r][1:] != group[r][:-1]]))
            of = group[r][begin]
            mine = np.zeros((len(of), n), data.dtype)
            has = np.flatnonzero(own[r])
            mine[np.searchsorted(of, group[r][has])] = m[has]
            best, letter = np.zeros((len(of), n), "i4"), np.zeros((len(of), n), data.dtype)
            for x in np.unique(m):
                score = 2 * np.add.reduceat((m == x).view("u1"), begin, axis=0, dtype="i4")
                score += (mine == x) & (score > 0)
                better = score > best
                best[better], letter[better] = score[better], x
            text = letter.tobytes().decode("ascii" if letter.dtype == np.uint8 else "utf-32-le")
            seq[of] = [text[k : k + n] for k in range(0, len(text), n)]
            used[of] = np.diff(np.append(begin, len(r)))
        return pa.RecordBatch.from_arrays([pa.array(aread[first], pa.int64()), pa.array(tile[first], pa.int64()), pa.array(seq, pa.string()), pa.array(used, pa.int64())], ["aread", "tile", "seq", "used"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) < VOTES:
            continue
        rows = pa.Table.from_batches(held)
        aread, tile = rows.column("aread").to_numpy(), rows.column("tile").to_numpy()
        # The last tile may go on in the next batch.
        rest = np.flatnonzero((aread != aread[-1]) | (tile != tile[-1]))
        whole = int(rest[-1]) + 1 if len(rest) else 0
        if whole:
            yield vote(rows.slice(0, whole))
            held = rows.slice(whole).combine_chunks().to_batches()
    if held:
        yield vote(pa.Table.from_batches(held))
