"""Text columns: cleaning, parsing, keys and labels.

``slugify`` is the only pandas function; Spark has no Unicode decomposition.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that mark a landing in a name.
LANDING_WORDS = ("landing", "atterrissage", "landeplatz")
# How heights are written, in metres and in feet.
METRES = r"(?i)(\d[\d,]*(?:\.\d+)?)\s*m\b"
FEET = r"(?i)(\d[\d,]*(?:\.\d+)?)\s*(?:ft|')"


def bound(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean_text(x: Column) -> Column:
    """Stripped of any white space at its ends; null if nothing is left."""
    return F.nullif(F.regexp_replace(x.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def infer_role(name: Column) -> Column:
    return F.when(F.lower(name).rlike("|".join(LANDING_WORDS)), "landing").otherwise("launch")


def unsigned_decimal(x: Column) -> Column:
    """A double if the text is digits with one point at most."""
    return F.when(x.rlike(r"^(\d+\.?\d*|\.\d+)$"), x.try_cast("double"))


def parse_height(x: Column) -> Column:
    """The first figure in metres, else the first in feet as metres (0.1), else null; numbers pass."""
    text = x.cast("string")
    number = lambda pattern: F.regexp_replace(F.regexp_extract(text, pattern, 1), ",", "").try_cast("double")
    return F.coalesce(number(METRES), F.round(number(FEET) * 0.3048, 1), F.when(text.rlike(r"^-?\d+(\.\d+)?$"), text.try_cast("double")))


def ring_centroid(rings: Column) -> Column:
    """struct(lat, lon): mean of the first ring's vertices "lon,lat lon,lat"; bad vertices are skipped."""
    vertices = F.transform(
        F.split(F.get(rings, F.lit(0)), r"\s+"),
        lambda p: F.struct(F.split_part(p, F.lit(","), F.lit(2)).try_cast("double").alias("lat"), F.split_part(p, F.lit(","), F.lit(1)).try_cast("double").alias("lon")),
    )
    good = F.filter(vertices, lambda v: v["lat"].isNotNull() & v["lon"].isNotNull())
    mean = lambda c: F.aggregate(good, F.lit(0.0), lambda a, v: a + v[c]) / F.size(good)
    return F.when(F.size(good) > 0, F.struct(mean("lat").alias("lat"), mean("lon").alias("lon")))


def approximate_flag(x: Column) -> Column:
    return F.coalesce(x.rlike(r"(?i)available to .*members"), F.lit(False))


def german_compass(x: Column) -> Column:
    """Ost to East inside whole compass tokens."""
    for token in ("NNO", "SSO", "ONO", "OSO", "NO", "SO", "O"):
        x = F.regexp_replace(x, rf"(?U)\b{token}\b", token.replace("O", "E"))
    return x


def normalise_newlines(x: Column) -> Column:
    return F.regexp_replace(x, "\r\n?", "\n")


def numeric_id(x: Column) -> Column:
    return F.substring_index(x, "-", -1).cast("int")


def ref_for(sources: Column, precedence: tuple[str, ...]) -> Column:
    """provider:id of the most preferred guide, else of the first by name."""
    first = F.array_min(F.map_keys(sources))
    provider = F.coalesce(*[F.when(F.map_contains_key(sources, F.lit(p)), F.lit(p)) for p in precedence], first)
    return F.concat(provider, F.lit(":"), F.element_at(sources, provider))


def encode_tokens(sources: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(sources), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))), ";")


def decode_tokens(text: Column) -> Column:
    """map provider -> id; tokens without either are ignored, a provider's last token wins."""
    cut = F.transform(
        F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda t: t.rlike("(?s)^[^:]+:.+$")),
        lambda t: F.struct(F.split_part(t, F.lit(":"), F.lit(1)).alias("p"), F.regexp_replace(t, "(?s)^[^:]*:", "").alias("i")),
    )
    last = F.filter(cut, lambda x, i: ~F.exists(F.slice(cut, i + 2, F.size(cut)), lambda y: y["p"] == x["p"]))
    return F.map_from_entries(last)


def override_entry(a: Column, b: Column, verdict: str) -> Column:
    return F.format_string('{"a": "%s", "b": "%s", "verdict": "' + verdict + '", "reason": ""}', a, b)


def member_label(provider: Column, name: Column, url: Column) -> Column:
    safe = F.replace(name, F.lit("|"), F.lit("\\|"))
    return F.concat(F.lit("**"), provider, F.lit("** "), F.when(url.isNotNull() & (url != ""), F.concat(F.lit("["), safe, F.lit("]("), url, F.lit(")"))).otherwise(safe))


def page_url(link: Column, default: Column) -> Column:
    """The guide's own link on https, else the default page."""
    link = clean_text(link)
    return F.when(link.isNull(), default).otherwise(F.regexp_replace(link, "^http://", "https://"))


_FOLD = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"})


def slug(name: str) -> str:
    plain = unicodedata.normalize("NFKD", name.lower().translate(_FOLD)).encode("ascii", "ignore").decode()
    return "-".join(re.findall("[a-z0-9]+", plain))


@F.pandas_udf(StringType())
def slugify(names: pd.Series) -> pd.Series:
    return names.map(slug, na_action="ignore")


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each character of b."""
    places: dict[str, int] = {}
    for i, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << i
    state = (1 << len(b)) - 1
    for c in a:
        hit = state & places.get(c, 0)
        state = (state + hit) | (state - hit)
    return len(b) - (state & (1 << len(b)) - 1).bit_count()


def similarity(a: str | None, b: str | None) -> float | None:
    """Token-set ratio, 0 to 100: shared words count fully, the rest by common subsequence."""
    if not a or not b:
        return None
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, p, q = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not p or not q):
        return 100.0
    gap = 1 if both else 0
    left, right = len(both) + gap + len(p), len(both) + gap + len(q)
    rate = lambda distance, total: 100.0 - 100.0 * distance / total
    best = rate(len(p) + len(q) - 2 * common_length(p, q), left + right)
    if both:
        best = max(best, rate(gap + len(p), len(both) + left), rate(gap + len(q), len(both) + right))
    return best


#: Bits of a word of the longest common subsequence; two such numbers and a carry fit in a bigint.
WORD = 62


def _power(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def _marks(bits: Column, c: Column) -> Column:
    """The bits of the characters (c, bit) that equal c."""
    return F.aggregate(bits, F.lit(0).cast("long"), lambda m, x: F.when(x["c"] == c, m.bitwiseOR(x["bit"])).otherwise(m))


def _with_bits(chars: Column) -> Column:
    return F.transform(chars, lambda c, i: F.struct(c.alias("c"), _power(i).alias("bit")))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def common_count(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts, as a column: a bit for each character of b, in words of
    ``WORD`` bits whose additions carry over. The bits that are cleared at the end are counted."""

    def step(full: Column, state: Column, hit: Column, carry: Column) -> Column:
        return bound(state + hit + carry, lambda total: F.struct(total.bitwiseOR(state - hit).bitwiseAND(full).alias("word"), F.shiftright(total, WORD).alias("carry")))

    def one(full: Column) -> Column:
        return bound(_with_bits(_chars(b)), lambda bits: F.aggregate(_chars(a), full, lambda state, c: step(full, state, state.bitwiseAND(_marks(bits, c)), F.lit(0).cast("long"))["word"]))

    def several(chars: Column) -> Column:
        cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size(chars) - 1) / WORD).cast("int")), lambda j: F.slice(chars, j * WORD + 1, F.lit(WORD)))
        words = F.transform(cuts, lambda cut: F.struct(_with_bits(cut).alias("bits"), (_power(F.size(cut)) - 1).alias("full")))

        def across(words: Column, state: Column, c: Column) -> Column:
            start = F.struct(F.array().cast("array<bigint>").alias("done"), F.lit(0).cast("long").alias("carry"))

            def add(acc: Column, pair: Column) -> Column:
                hit = pair["state"].bitwiseAND(_marks(pair["word"]["bits"], c))
                # the last word may be shorter: bits beyond its characters are dropped by its mask
                stepped = bound(hit, lambda h: step(pair["word"]["full"], pair["state"], h, acc["carry"]))
                return bound(stepped, lambda r: F.struct(F.concat(acc["done"], F.array(r["word"])).alias("done"), r["carry"].alias("carry")))

            return F.aggregate(F.zip_with(words, state, lambda w, s: F.struct(w.alias("word"), s.alias("state"))), start, add)["done"]

        end = bound(words, lambda w: F.aggregate(_chars(a), F.transform(w, lambda x: x["full"]), lambda state, c: across(w, state, c)))
        return F.aggregate(end, F.lit(0), lambda n, x: n + F.bit_count(x))

    single = bound(_power(F.length(b)) - 1, lambda full: F.bit_count(one(full)))
    left = F.when(F.length(b) <= WORD, single).otherwise(bound(_chars(b), several))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.length(b) - left)


def name_similarity(a: Column | str, b: Column | str) -> Column:
    """Token-set ratio, 0 to 100, of built-in functions: shared words count fully, the rest by common subsequence; null if a
    name is null or empty, 0 if one has no words."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    tokens = lambda s: F.array_distinct(F.filter(F.split(s, r"(?U)[\s\x1c-\x1f]+"), lambda t: t != ""))
    joined = lambda t: F.array_join(F.array_sort(t), " ")

    def parts(sets: Column) -> Column:
        x, y = sets["x"], sets["y"]
        cut = F.struct(joined(F.array_intersect(x, y)).alias("both"), joined(F.array_except(x, y)).alias("p"), joined(F.array_except(y, x)).alias("q"))
        return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(bound(cut, ratio))

    def ratio(s: Column) -> Column:
        n, p, q = (F.length(s[c]) for c in ("both", "p", "q"))
        gap = F.when(n > 0, 1).otherwise(0)
        rate = lambda distance, total: 100.0 - 100.0 * distance / total
        by_rest = rate(p + q - 2 * common_count(s["p"], s["q"]), 2 * (n + gap) + p + q)
        shared = F.greatest(by_rest, rate(gap + p, 2 * n + gap + p), rate(gap + q, 2 * n + gap + q))
        return F.when((n > 0) & ((p == 0) | (q == 0)), 100.0).when(n > 0, shared).otherwise(by_rest)

    sets = F.struct(tokens(a).alias("x"), tokens(b).alias("y"))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), bound(sets, parts))
