"""What a task holds of k-mer places doesn't grow with its part of the table."""

import numpy as np
import pyarrow as pa

from readweave.operators import letters, reads


def test_few_letters_at_once(monkeypatch):
    """Stretches are up to 32 thousand letters long: so many of them are not made to k-mers at once, nor held before they are sent."""
    rng = np.random.default_rng(3)
    text = ["".join(rng.choice(list("acgt"), n)) for n in (0, 5, 20, 400, 400, 13, 400, 400, 90)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array([0] * 9), pa.array([*text[:-1], None]), pa.array([0] * 9, pa.int32())], ["rid", "_c", "_s", "strand"])
    want = [list(c) for c in zip(*letters.unpack_places(letters.send_places(14, 500, 5, 1)([batch]), 14), strict=True)]
    held, codes = [], letters.kmer_codes
    monkeypatch.setattr(letters, "LETTERS_AT_ONCE", 500)
    monkeypatch.setattr(letters, "PLACES_AT_ONCE", 600)
    monkeypatch.setattr(letters, "kmer_codes", lambda s, k: held.append(sum(len(x or "") for x in s.to_pylist())) or codes(s, k))
    sent = list(letters.send_places(14, 500, 5, 1)([batch]))
    assert max(held) <= 500 + 400 and len(sent) > 1
    assert sorted(list(c) for c in zip(*letters.unpack_places(sent, 14), strict=True)) == sorted(want)


def test_parts_are_small():
    """Some 100 bytes a place, two tasks beside the 1800 MB of an executor of 3000."""
    assert 2 * 100 * reads.PART < 600_000_000 and 2 * 100 * letters.PLACES_AT_ONCE < 1_200_000_000


def test_neighbours_go_to_the_same_part():
    """A stretch that two reads share meets in few parts; every place goes to one part, that of its k-mer."""
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("acgt"), 3000))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([0, 0]), pa.array([text, text]), pa.array([0, 1], pa.int32())], ["rid", "_c", "_s", "strand"])
    sent = [r for b in letters.send_places(14, 4000, 5, 1 << 15, together=True)([batch]) for r in b.to_pylist()]
    part = {}
    for r in sent:
        for x in np.frombuffer(r["code"], "<u4").tolist():
            assert part.setdefault(x, r["part"]) == r["part"]
    follow = letters.kmer_codes(pa.array([text]), 14)[0].tolist()
    assert set(follow) == set(part) and sum(part[x] != part[y] for x, y in zip(follow, follow[1:])) < len(follow) / 2
