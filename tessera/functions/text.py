"""String functions: name normalisation, identities, globs, paths and similarities."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize(name: Column) -> Column:
    """Lower case; runs of other characters than letters, digits and _ are spaces; single spaces; trimmed."""
    plain = F.regexp_replace(F.lower(name), r"(?U)[^\w\s]+", " ")
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def token_sort_key(norm: Column) -> Column:
    return F.array_join(F.array_sort(F.split(norm, " ")), " ")


def trigrams(norm: Column) -> Column:
    """The distinct three-character substrings; none of shorter text."""
    places = F.sequence(F.lit(1), F.length(norm) - 2)
    return F.when(F.length(norm) >= 3, F.array_distinct(F.transform(places, lambda i: F.substring(norm, i, 3)))).otherwise(F.array().cast("array<string>"))


def slugify(text: Column) -> Column:
    slug = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("x"))


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def mint(corpus: Column, path: Column, kind: Column) -> Column:
    """corpus:path#stem-kind, the last part in slugs."""
    return F.concat(corpus, F.lit(":"), path, F.lit("#"), slugify(stem(path)), F.lit("-"), slugify(kind))


CURIE = r"^([^:#]+):([^#]+)#(.+)$"


def decompose(curie: Column) -> Column:
    """corpus, path, slug and kind (what follows the slug's last -, or nothing) of an identity; null if it is not one."""
    part = lambda k: F.regexp_extract(curie, CURIE, k)
    return F.when(curie.rlike(CURIE), F.struct(part(1).alias("corpus"), part(2).alias("path"), part(3).alias("slug"), F.regexp_extract(part(3), "-([^-]*)$", 1).alias("kind")))


def glob_regex(glob: str) -> str:
    """A Java regex for a shell glob whose * crosses slashes."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append("[" + ("^" + body[1:] if body[0] == "!" else "\\" + body if body[0] == "^" else body) + "]")
            i = close
        else:
            out.append(re.sub(r"([^\w])", r"\\\1", c, flags=re.ASCII) if c.isascii() else c)
        i += 1
    return "(?s)^" + "".join(out) + "$"


def glob_match(path: Column, glob: str) -> Column:
    return path.rlike(glob_regex(glob))


def safe_path(path: Column) -> Column:
    """Relative, without empty, . or .. parts, .git, backslashes or control characters."""
    parts = F.split(path, "/")
    return (F.length(path) > 0) & ~path.rlike(r"[\\\x00-\x1f\x7f]") & ~F.exists(parts, lambda p: p.isin("", ".", "..") | (F.lower(p) == ".git"))


def relative_path(base: Column, path: Column) -> Column:
    """path taken from the folder base, without . and ..; null if empty, if it has \\ or %, or if it leaves the root."""
    start = F.filter(F.split(base, "/"), lambda p: p != "")
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    step = lambda acc, p: F.when(acc.isNull(), acc).when((p == "..") & (F.size(acc) == 0), F.lit(None)).when(p == "..", F.slice(acc, 1, F.size(acc) - 1)).otherwise(F.concat(acc, F.array(p)))
    found = F.array_join(F.aggregate(parts, start, step), "/")
    return F.when((path != "") & ~path.rlike(r"[\\%]") & ~path.startswith("/"), F.nullif(found, F.lit("")))


def plain_relative_path(path: Column) -> Column:
    """Forward slashes, no leading ./ parts."""
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"^(\./+)+", "")


def hash_bucket(text: Column, buckets: int) -> Column:
    """The 256-bit SHA-256 of a text, modulo a number of buckets."""
    digits = F.transform(F.split(F.sha2(text, 256), ""), lambda d: F.conv(d, 16, 10).cast("long"))
    digits = F.filter(digits, lambda d: d.isNotNull())
    return F.aggregate(digits, F.lit(0).cast("long"), lambda acc, d: (acc * 16 + d) % buckets)


def suffix(path: Column) -> Column:
    """.ext of the file name in lower case; (none) without one."""
    found = F.lower(F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]+)$", 1))
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("(none)"))


def lane_numbers(text: Column) -> Column:
    """Numbers of a list such as L01–L03, L20: ranges spelt out, each number once, in order of appearance."""
    firsts = F.regexp_extract_all(text, F.lit(r"L(\d+)(?:\s*[–-]\s*L?(\d+))?"), F.lit(1))
    lasts = F.regexp_extract_all(text, F.lit(r"L(\d+)(?:\s*[–-]\s*L?(\d+))?"), F.lit(2))
    spans = F.zip_with(firsts, lasts, lambda a, b: F.sequence(a.cast("int"), F.when(b == "", a).otherwise(b).cast("int")))
    return F.array_distinct(F.flatten(spans))


def row_digest(*cells: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *[F.trim(c) for c in cells]), 256)


def is_definition(mask: Column) -> Column:
    """A symbol role as a bit mask: bit 0 marks a definition."""
    return mask.bitwiseAND(1) == 1


def is_definition_list(roles: Column) -> Column:
    return F.array_contains(F.transform(roles, F.lower), "definition")


@F.pandas_udf(T.StringType())
def casefold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


def _points(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), width), np.uint32)
    out[np.arange(width) < n[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, n


def jaro_winkler_many(left: list[str], right: list[str]) -> np.ndarray:
    """Jaro-Winkler similarities of pairs, all pairs at once; two empty texts have 1."""
    if not left:
        return np.zeros(0)
    width = max(1, max(map(len, left)), max(map(len, right)))
    a, na = _points(left, width)
    b, nb = _points(right, width)
    reach = np.maximum(np.maximum(na, nb) // 2 - 1, 0)[:, None]
    place, rows = np.arange(width)[None, :], np.arange(len(left))
    used, hit = np.zeros(b.shape, bool), np.zeros(a.shape, bool)
    inside = place < nb[:, None]
    for i in range(int(na.max())):
        free = (b == a[:, i : i + 1]) & ~used & inside & (np.abs(place - i) <= reach) & (i < na)[:, None]
        j = free.argmax(1)
        got = free[rows, j]
        used[rows[got], j[got]] = True
        hit[:, i] = got
    m = hit.sum(1)
    in_a = np.take_along_axis(a, np.argsort(~hit, axis=1, kind="stable"), 1)
    in_b = np.take_along_axis(b, np.argsort(~used, axis=1, kind="stable"), 1)
    moved = ((in_a != in_b) & (place < m[:, None])).sum(1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / na + m / nb + (m - moved) / m) / 3, 0.0)
    jaro = np.where((na == 0) & (nb == 0), 1.0, jaro)
    four = min(4, width)
    same = (a[:, :four] == b[:, :four]) & (place[:, :four] < np.minimum(na, nb)[:, None])
    prefix = np.cumprod(same, 1).sum(1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)


def indel_many(left: list[str], right: list[str]) -> np.ndarray:
    """1 less insertions and deletions over both lengths: twice the longest common subsequence over both lengths."""
    out = np.ones(len(left))
    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        if a or b:
            at: dict[str, int] = {}
            for i, c in enumerate(a):
                at[c] = at.get(c, 0) | 1 << i
            full = (1 << len(a)) - 1
            row = full
            for c in b:
                u = row & at.get(c, 0)
                row = (row + u | row - u) & full
            out[k] = 2 * (len(a) - row.bit_count()) / (len(a) + len(b))
    return out


def _in_parts(many, left: pd.Series, right: pd.Series) -> pd.Series:
    out = [many(left.iloc[a : a + 2000].tolist(), right.iloc[a : a + 2000].tolist()) for a in range(0, len(left), 2000)]
    return pd.Series(np.concatenate(out) if out else np.zeros(0))


@F.pandas_udf(T.DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return _in_parts(jaro_winkler_many, left, right)


@F.pandas_udf(T.DoubleType())
def indel(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in pairs:
        yield _in_parts(indel_many, left, right)
