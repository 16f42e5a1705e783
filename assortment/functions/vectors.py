"""Vector columns."""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

NO_TOKEN = r"[^\p{L}\p{N}]+"


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; never below 0; NULL when a vector is NULL or all zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, F.greatest(F.lit(0.0), 1 - dot(a, b) / scale))


def has_vector(a: Column) -> Column:
    """Not NULL and not empty."""
    return a.isNotNull() & (F.size(a) > 0)


def has_direction(a: Column, length: int | None = None) -> Column:
    """The one rule for vectors that take part in a search: every part a finite number, a finite norm over 0,
    and `length` parts if given. False for NULL."""
    size = norm(a)
    fits = has_vector(a) & (size > 0) & (size < float("inf"))
    fits = fits & (F.size(a) == length) if length else fits
    return F.coalesce(fits, F.lit(False))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a non-null list array of equal lengths as a 2-d array, without copying."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of unequal lengths")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(vectors), -1)


def unit_rows(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def list_array(m: np.ndarray) -> pa.ListArray:
    """Rows of a 2-d array as a list array."""
    n, d = m.shape
    offsets = pa.array(np.arange(0, n * d + 1, d if d else 1, dtype=np.int32)[: n + 1])
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m).ravel()))


def distance_to(vector: Column, query: list[float]) -> Column:
    """Cosine distance of a column of vectors to one fixed vector, one matrix product per batch.

    NULL for a vector without direction and for one of another length.
    """
    q = np.asarray(query, dtype=np.float64)
    if not 0 < np.linalg.norm(q) < np.inf:
        raise ValueError("the query vector has no direction")
    q = q / np.linalg.norm(q)

    @arrow_udf("double")
    def distance(v: pa.Array) -> pa.Array:
        out = np.full(len(v), np.nan)
        ok = pc.fill_null(pc.equal(pc.list_value_length(v), len(q)), False)
        rows = v.filter(ok)
        if len(rows):
            m = matrix(rows)
            with np.errstate(all="ignore"):
                size = np.sqrt(np.einsum("ij,ij->i", m, m))
                found = np.maximum(0.0, 1.0 - (m @ q) / size)
            found[~((size > 0) & (size < np.inf))] = np.nan
            out[ok.to_numpy(zero_copy_only=False)] = found
        return pa.array(out, mask=np.isnan(out))

    return distance(vector)


def bucket_of(token: str, dim: int) -> int:
    """Signed bucket of a token: +-(bucket + 1), from its md5 digest; 0 for no token."""
    if not token:
        return 0
    digest = hashlib.md5(token.encode()).hexdigest()
    place = int(digest[:8], 16) % dim + 1
    return place if digest[8] < "8" else -place


def hashed_vector(text: Column, dim: int) -> Column:
    """Unit vector of a text: the signed buckets of its lower-case tokens, summed.

    NULL when there is no token or all of them cancel out. A batch is split, encoded and summed as
    arrays; only its distinct tokens are hashed one by one.
    """

    def assemble(part: pa.Array) -> pa.Array:
        words = pc.split_pattern_regex(pc.utf8_lower(part), NO_TOKEN)
        rows = np.repeat(np.arange(len(part)), words.value_lengths().fill_null(0).to_numpy())
        coded = words.flatten().dictionary_encode()
        buckets = np.array([bucket_of(t, dim) for t in coded.dictionary.to_pylist()], dtype=np.int64)
        signed = buckets[coded.indices.to_numpy()] if len(buckets) else np.empty(0, np.int64)
        filled = signed != 0
        cell = rows[filled] * dim + np.abs(signed[filled]) - 1
        sums = np.bincount(cell, weights=np.sign(signed[filled]), minlength=len(part) * dim)
        sums = sums.reshape(-1, dim)
        size = np.linalg.norm(sums, axis=1)
        unit = list_array(sums / np.where(size > 0, size, 1.0)[:, None])
        return pc.if_else(pa.array(size > 0), unit, pa.scalar(None, unit.type))

    @arrow_udf("array<double>")
    def embed(texts: pa.Array) -> pa.Array:
        step = max(1, (1 << 22) // dim)
        parts = [assemble(texts.slice(start, step)) for start in range(0, len(texts), step)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

    return embed(text)
