"""Column functions on DNA strings and Phred+33 qualities (ASCII). Null in, null out.

What needs every letter (scores, pairs of letters) is summed in numpy over Arrow batches, which takes a small part of the
time of a lambda for each letter; all else is built-in expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The bases that each ambiguity code stands for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
_CODES = "ACGTRYSWKMBDHVNacgtryswkmbdhvn"
_COMPLEMENTS = "TGCAYRSWMKVHDBNtgcayrswmkvhdbn"


def ascii_bytes(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of an Arrow batch and where each begins, and the end."""
    a = a.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1, 8 * a.offset)
    return np.frombuffer(a.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _per_string(ufunc: np.ufunc, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``ufunc`` reduced over the values of each string; 0 for empty ones."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = ufunc.reduceat(values, bounds[:-1][full])
    return out


_CHANCE = 10.0 ** (-(np.arange(256) - 33) / 10.0)


@F.arrow_udf(T.StructType().add("total", T.LongType()).add("errors", T.DoubleType()))
def _quality(q: pa.Array) -> pa.Array:
    raw, bounds = ascii_bytes(q)
    total = _per_string(np.add, raw.astype(np.int64) - 33, bounds)
    return pa.StructArray.from_arrays([pa.array(total), pa.array(_per_string(np.add, _CHANCE[raw], bounds))], ["total", "errors"])


@F.arrow_udf(T.StructType().add("pairs", T.IntegerType()).add("entropy", T.DoubleType()))
def _sequence(s: pa.Array) -> pa.Array:
    raw, bounds = ascii_bytes(s)
    raw = np.where((raw >= 97) & (raw <= 122), raw - 32, raw)
    return pa.StructArray.from_arrays([pa.array(_distinct_pairs(raw, bounds)), pa.array(_entropy(raw, bounds))], ["pairs", "entropy"])


def _distinct_pairs(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Distinct pairs of adjacent letters of each string."""
    letters = np.flatnonzero(np.bincount(raw, minlength=256))
    n, rows = len(letters), len(bounds) - 1
    if len(raw) < 2:
        return np.zeros(rows, np.int32)
    code = np.zeros(256, np.int64)
    code[letters] = np.arange(n)
    pair = code[raw[:-1]] * n + code[raw[1:]]
    own = np.repeat(np.arange(rows), np.diff(bounds))
    inside = own[1:] == own[:-1]
    if n * n <= 64:
        bits = np.append(np.where(inside, np.uint64(1) << pair.astype(np.uint64), np.uint64(0)), np.uint64(0))
        return np.bitwise_count(_per_string(np.bitwise_or, bits, bounds)).astype(np.int32)
    distinct = np.unique(own[1:][inside] * n * n + pair[inside])
    return np.bincount(distinct // (n * n), minlength=rows).astype(np.int32)


def _entropy(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Entropy in bits of the shares of A, C, G and T of each string; 0 without any."""
    n = np.stack([_per_string(np.add, (raw == ord(b)).astype(np.int64), bounds) for b in "ACGT"])
    p = n / np.maximum(n.sum(axis=0), 1)
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(axis=0) + 0.0


def phred(q: Column) -> Column:
    """Quality scores as an array of int."""
    return F.transform(F.filter(F.split(q, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def mean_phred(q: Column) -> Column:
    """Arithmetic mean of the scores; 0 for an empty string. Summed in numpy, a batch of strings at a time."""
    return F.when(q.isNotNull(), F.coalesce(F.try_divide(_quality(q)["total"].cast("double"), F.length(q)), F.lit(0.0)))


def expected_errors(q: Column) -> Column:
    """Sum of the error probabilities 10^(-Q/10). Summed in numpy, a batch of strings at a time."""
    return F.when(q.isNotNull(), _quality(q)["errors"])


def mean_error_phred(q: Column) -> Column:
    """Score of the mean error probability; null for an empty string."""
    return -10 * F.log10(F.try_divide(expected_errors(q), F.length(q)))


def kmers(s: Column, k: int) -> Column:
    """All substrings of length k, in order; empty for shorter strings."""
    # the string is bound once, not computed again at every position
    one = F.transform(F.array(s), lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - k + 1, F.lit(1))), lambda i: F.substr(x, i, F.lit(k))))[0]
    return F.when(F.length(s) >= k, one).otherwise(F.array().cast("array<string>"))


def complexity(s: Column) -> Column:
    """Distinct pairs of adjacent letters, out of 16."""
    return F.when(s.isNotNull(), _sequence(s)["pairs"] / F.lit(16.0))


def base_entropy(s: Column) -> Column:
    """Entropy in bits of the shares of A, C, G and T; 0 without any."""
    return F.when(s.isNotNull(), _sequence(s)["entropy"])


def revcomp(s: Column) -> Column:
    """Reverse complement, ambiguity codes included."""
    return F.reverse(F.translate(s, _CODES, _COMPLEMENTS))


def iupac_mask(c: Column) -> Column:
    """Bit set (A 1, C 2, G 4, T 8) of a base or code; null for other characters."""
    out = F
    for code, bases in IUPAC.items():
        out = out.when(c == code, sum(1 << "ACGT".index(b) for b in bases))
    return out.otherwise(F.lit(None).cast("int"))


def iupac_compatible(a: Column, b: Column) -> Column:
    """Whether two codes share a base; unknown characters fit themselves only."""
    both = iupac_mask(a).bitwiseAND(iupac_mask(b)) > 0
    return F.coalesce(both, a == b)


def iupac_regex(primer: str) -> str:
    """Regular expression of a primer: a character class for each code."""
    return "".join(c if len(IUPAC.get(c, c)) == 1 else f"[{IUPAC[c]}]" for c in primer.upper())


def count_n(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(F.upper(s), F.lit("N"), F.lit("")))


def fasta_id(header: Column) -> Column:
    return F.split(F.split(header, ";")[0], r"\s")[0]


def fasta_size(header: Column) -> Column:
    """The ``;size=N`` of a header, 1 if there is none."""
    return F.coalesce(F.regexp_extract(header, r";size=(\d+)", 1).try_cast("bigint"), F.lit(1).cast("bigint"))


def fasta_sample(header: Column) -> Column:
    return F.nullif(F.regexp_extract(header, r";sample=([^;]+)", 1), F.lit(""))
