"""Column helpers: flags, strands, interval arithmetic, sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bit numbers of overlap flags.
FLAG_BITS = {"COMP": 0, "DISCARD": 1, "REPEAT": 3, "LOCAL": 4, "DIFF": 5, "STITCH": 7, "SYMDISCARD": 8, "OLEN": 9, "RLEN": 10, "TEMP": 11, "CONT": 15, "GAP": 16, "TRIM": 17, "MODULE": 18, "OPTIONAL": 19}

#: Recognition sites of restriction enzymes.
MOTIFS = {"HindIII": "aagctt", "DpnII": "gatc", "MboI": "gatc", "Sau3AI": "gatc"}


def bit(name: str) -> int:
    return 1 << FLAG_BITS[name]


def has(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(bit(name))) != 0


def set_flag(flags: Column, name: str, when: Column) -> Column:
    # ``flags`` comes once, so that a chain of rules grows with their number.
    return flags.bitwiseOR(F.when(when, F.lit(bit(name))).otherwise(F.lit(0)))


def flag_labels(flags: Column) -> Column:
    """Names of the set bits in the order of their numbers, comma between."""
    names = [F.when(has(flags, n), F.lit(n)) for n in FLAG_BITS]
    return F.concat_ws(",", *names)


def common(ab: Column, ae: Column, bb: Column, be: Column) -> Column:
    """Length that two intervals share."""
    return F.greatest(F.lit(0), F.least(ae, be) - F.greatest(ab, bb))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def forward_b(comp: Column, blen: Column, bb: Column, be: Column) -> tuple[Column, Column]:
    """B coordinates on the forward strand."""
    return F.when(comp == 1, blen - be).otherwise(bb), F.when(comp == 1, blen - bb).otherwise(be)


def edge_divergence(diffs: Column, aspan: Column, bspan: Column) -> Column:
    """Of an edge: truncated percent of both spans."""
    return F.floor(200 * diffs / (aspan + bspan))


def filter_divergence(diffs: Column, alen: Column, blen: Column) -> Column:
    """Of the overlap filter: share of the shorter span."""
    return diffs / F.least(alen, blen)


def display_identity(diffs: Column, aspan: Column) -> Column:
    return 100 - 100 * diffs / aspan


def parse_bases(text: Column) -> Column:
    """1.5g, 200m, 30k or a plain number as bases."""
    n = F.regexp_extract(text, r"^([0-9.]+)", 1).cast("double")
    unit = F.lower(F.regexp_extract(text, r"([kKmMgG])", 1))
    return F.floor(n * F.when(unit == "g", 1e9).when(unit == "m", 1e6).when(unit == "k", 1e3).otherwise(1.0))
