"""Token estimates, costs, score rounding, quantised vectors, cursors, canonical records."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def page_tokens(chars: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.floor(chars / 4).cast("long"))


def ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + F.lit(b - 1)) / b).cast("long")


def planned_tokens(size: Column, overhead_percent: int) -> Column:
    """Four bytes a token, rounded up, times an overhead, rounded up."""
    return ceil_div(ceil_div(size, 4) * overhead_percent, 100)


def cost(input_tokens: Column, output_tokens: Column, input_rate: str, output_rate: str) -> Column:
    """Exact decimal cost at rates for a million tokens, rounded up to six places."""
    rate = lambda r: F.lit(r).cast("decimal(18,9)")
    total = input_tokens.cast("decimal(18,0)") * rate(input_rate) + output_tokens.cast("decimal(18,0)") * rate(output_rate)
    return F.ceil(total.cast("decimal(28,9)") / F.lit(1000000).cast("decimal(7,0)"), F.lit(6)).cast("decimal(38,6)")


def score_6(score: Column) -> Column:
    """The nearest number of six places to the number itself (not to its shortest decimal text); exact halves to even.

    A million times the score is worked out as a number and its exact error: the score is split into halves of 26 bits,
    whose products with a million are exact.
    """
    million = F.lit(1e6)
    x = F.abs(score.cast("double"))
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    p = x * million
    error = (high * million - p) + (x - high) * million
    below = F.floor(p).cast("double")
    over = (p - below) - 0.5  # exact, and larger than the error unless it is 0
    up = (over > 0) | (over == 0) & ((error > 0) | (error == 0) & (below % 2 == 1))
    near = (below + F.when(up, 1.0).otherwise(0.0)) / million
    # from 2**33 on, doubles have no more than six places
    return F.when((x > 0) & (x < 8589934592.0), F.when(score < 0, -near).otherwise(near)).otherwise(score.cast("double"))


def ascii_json(text: Column) -> Column:
    """A JSON string of ASCII characters alone: others, and control characters, as \\u and their UTF-16 units."""
    units = F.hex(F.encode(text, "UTF-16BE"))
    short = F.create_map(*[F.lit(x) for pair in (("0022", '\\"'), ("005C", "\\\\"), ("000A", "\\n"), ("000D", "\\r"), ("0009", "\\t"), ("0008", "\\b"), ("000C", "\\f")) for x in pair])

    def shown(k: Column) -> Column:
        unit = F.substring(units, 4 * k + 1, F.lit(4))
        plain = unit.between("0020", "007E")
        return F.coalesce(F.try_element_at(short, unit), F.when(plain, F.char(F.conv(unit, 16, 10).cast("int"))).otherwise(F.concat(F.lit("\\u"), F.lower(unit))))

    hard = F.array_join(F.transform(F.sequence(F.lit(0), (F.length(units) / 4).cast("int") - 1), shown), "")
    return F.concat(F.lit('"'), F.when(text.rlike(r"^[ !#-\[\]-~]*$"), text).otherwise(hard), F.lit('"'))


def json_number(x: Column) -> Column:
    """A number as JSON has it: the shortest digits, with an exponent only below 0.0001 and from 1e16 on."""
    text = F.abs(x.cast("double")).cast("string")
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", ""), r"\.", "")
    power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int"))
    whole = F.concat(F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0")), F.lit("."), F.coalesce(F.nullif(F.substring(digits, power + 2, F.lit(17)), F.lit("")), F.lit("0")))
    rest = F.substring(digits, 2, 17)
    exponent = F.concat(F.substring(digits, 1, 1), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    shown = F.when(power.isNull(), text).when(power == -4, F.concat(F.lit("0.000"), digits)).when(power.between(0, 15), whole).otherwise(exponent)
    return F.concat(F.when(x.cast("string").startswith("-"), "-").otherwise(""), shown)


def encode_cursor(score: Column, node_id: Column) -> Column:
    """base64url, unpadded, of the JSON list of a score of six places and an id."""
    raw = F.concat(F.lit("["), json_number(score_6(score)), F.lit(","), ascii_json(node_id), F.lit("]"))
    return F.rtrim(F.translate(F.base64(raw.cast("binary")), "+/\r\n", "-_"), F.lit("="))


def decode_cursor(cursor: Column) -> Column:
    """score and node_id of a cursor."""
    padded = F.rpad(F.translate(cursor, "-_", "+/"), F.floor((F.length(cursor) + 3) / 4).cast("int") * 4, F.lit("="))
    raw = F.unbase64(padded).cast("string")
    return F.struct(F.get_json_object(raw, "$[0]").cast("double").alias("score"), F.get_json_object(raw, "$[1]").alias("node_id"))


_CANONICAL = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=True, allow_nan=False)


def canonical(record: object) -> str:
    """Sorted keys, no spaces, ASCII only, no NaN: the text that identities are digests of."""
    return _CANONICAL.encode(record)


def bounded_text(text: Column) -> Column:
    return F.length(text).between(1, 4096) & ~text.rlike(r"[\x00-\x1f]")


def hex_digest(text: Column, digits: int = 64) -> Column:
    return text.rlike(f"^[0-9a-f]{{{digits}}}$")


def git_blob_id(content: Column, digits: int = 40) -> Column:
    """The object id of a file's content: SHA-1 of 40 digits, or SHA-256 of 64."""
    head = F.concat(F.lit("blob "), F.octet_length(content).cast("string")).cast("binary")
    whole = F.concat(head, F.lit(b"\0"), content)
    return F.sha1(whole) if digits == 40 else F.sha2(whole, 256)


def int8_scale(vector: Column) -> Column:
    """The largest magnitude (1e-12 at least) over 127."""
    return F.greatest(F.array_max(F.transform(vector, F.abs)), F.lit(1e-12).cast("float")).cast("double") / 127


def _stacked(vectors: pd.Series) -> Iterator[tuple[list[int], np.ndarray]]:
    """The vectors of a batch as one array for each number of components, with their places; nulls are in none."""
    places: dict[int, list[int]] = {}
    for k, v in enumerate(vectors):
        if v is not None:
            places.setdefault(len(v), []).append(k)
    for size, at in places.items():
        yield at, np.array([vectors.iloc[k] for k in at], np.float32).reshape(len(at), size)


@F.pandas_udf(T.ArrayType(T.ByteType()))
def to_int8(vectors: pd.Series) -> pd.Series:
    """Symmetric quantisation in single precision, halves to even."""
    out: list = [None] * len(vectors)
    for at, x in _stacked(vectors):
        scale = np.maximum(np.abs(x).max(axis=1, initial=0), np.float32(1e-12)) / np.float32(127)
        for k, row in zip(at, np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8), strict=True):
            out[k] = row
    return pd.Series(out)


@F.pandas_udf(T.BinaryType())
def to_bits(vectors: pd.Series) -> pd.Series:
    """One bit for each component above 0, the first component in the highest bit of the first byte."""
    out: list = [None] * len(vectors)
    for at, x in _stacked(vectors):
        for k, row in zip(at, np.packbits(x > 0, axis=1), strict=True):
            out[k] = row.tobytes()
    return pd.Series(out, dtype=object)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two bit vectors of eight whole bytes."""
    word = lambda x: F.conv(F.hex(x), 16, -10).cast("long")
    return F.bit_count(word(a).bitwiseXOR(word(b)))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))
