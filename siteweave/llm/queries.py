"""The queries op1 to op13 and their SQL; each reads whole tables."""

from __future__ import annotations

import secrets

from pyspark.sql import functions as F

from siteweave.llm import decontaminate, langid, lm, negatives, packing, pii, quality, shards, simhash, suffixes, tries, urls, windows

QUERIES: dict = {}
SQL: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- quality rules -------------------------------------------------------------------

@query
def op1_quality_rules(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
SQL["op1_quality_rules"] = rf"""
with w as (select row_number() over () rid, doc_id, coalesce(text, '') t, {_WORDS} words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines
           from documents),
c as (select rid, doc_id, len(words)::bigint n_words, length(array_to_string(words, ''))::bigint word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint n_symbols, len(lines)::bigint n_lines,
        (len(lines) - len(list_distinct(lines)))::bigint n_dup_lines,
        length(regexp_replace(t, '[^A-Z]+', '', 'g'))::bigint n_capitals,
        len(list_filter(words, lambda x: list_contains([{", ".join(repr(v) for w in quality.STOP_WORDS for v in (w, w.capitalize()))}], x)))::bigint n_stop_words,
        words from w),
g as (select rid, unnest(range(1, n_words - 1)) i, words from c where n_words >= 3),
h as (select rid, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] k from g),
r as (select rid, i from h qualify count(*) over (partition by rid, k) > 1),
p as (select rid, count(distinct i + d) n from r, (values (0), (1), (2)) x(d) group by rid),
m as (select c.* exclude (words), coalesce(n, 0)::bigint n_repeat_words from c left join p using (rid))
select doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_capitals, n_stop_words, n_repeat_words,
  (n_words < 50 or 100 * n_repeat_words > 50 * n_words) base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
    and word_chars >= 2 * n_words and word_chars <= 20 * n_words
    and n_symbols / n_words <= 0.25 and n_stop_words / n_words >= 0.03
    and (n_lines = 0 or n_dup_lines / n_lines <= 0.5) and n_capitals / word_chars <= 0.5 kept
from m"""


# --- near duplicates -----------------------------------------------------------------

@query
def op4_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


# --- benchmark decontamination -------------------------------------------------------

@query
def op8_decontaminate(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ITEM_WORDS = r"list_filter(regexp_split_to_array(lower_az(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = _ITEM_WORDS.replace("lower_az(coalesce(text, ''))", _AZ.format("coalesce(text, '')"))
SQL["op8_decontaminate"] = rf"""
with d as (select row_number() over () rid, doc_id, {_ITEM_WORDS} w from documents),
b as (select item_id, w, least(10, len(w)) k from (select item_id, {_ITEM_WORDS} w from benchmark) where len(w) > 0),
p as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') phrase
      from (select *, unnest(range(1, len(w) - k + 2)) i from b)),
n as (select distinct k from p),
g as (select rid, k, i, array_to_string(w[i:i + k - 1], ' ') phrase
      from (select rid, w, k, unnest(range(1, len(w) - k + 2)) i from d, n where len(w) >= k)),
o as (select rid, i, k, item_id from g join p using (k, phrase)),
h as (select rid, count(distinct j) n from (select rid, unnest(range(i, i + k)) j from (select distinct rid, i, k from o)) group by rid),
t as (select rid, count(distinct item_id) n, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) ids from o group by rid)
select doc_id, len(w)::bigint n_words, coalesce(h.n, 0)::bigint n_hit, coalesce(t.n, 0)::bigint n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(h.n, 0) > 0 contaminated
from d left join h using (rid) left join t using (rid)"""


# --- personal data -------------------------------------------------------------------

def pseudonym_key(spark) -> str:
    """From the session; where none is set a new secret one, so equal values are linked within a run only."""
    return spark.conf.get("spark.siteweave.pseudonym.key", None) or secrets.token_hex(32)


@query
def op6_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, pseudonym_key(spark), count="n_private")


# --- packing -------------------------------------------------------------------------

@query
def op9_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


# --- URL filters ---------------------------------------------------------------------

@query
def op10_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return urls.judged(urls.dated_captures(pages), urls.dated_entries(pages))


def _md5(x, start, size):
    return f"(('0x' || substr(md5({x}), {start}, 4))::int % {size})"


SQL["op10_url_filters"] = rf"""
with rests as (select page_id, regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.\-]*://', ''), '[?#].*$', '') rest from pages),
a as (select row_number() over () rid, page_id, {_md5('page_id::varchar', 1, 730)} as day,
  nullif(lower(regexp_replace(regexp_replace(regexp_extract(rest, '^[^/]*'), '^.*@', ''), '\.?(:\d*)?$', '')), '') host,
  regexp_extract(rest, '/.*$') path from rests),
v as (select distinct 'spam' list_name, host as value from a where host is not null
  union all select distinct 'malware', array_to_string(string_split(host, '.')[-2:], '.') from a where len(string_split(host, '.')) >= 2
  union all select distinct 'parked', host || '/' || regexp_extract(path, '^/([^/]+)/', 1) from a where host is not null and regexp_extract(path, '^/([^/]+)/', 1) <> ''),
n as (select list_name, value, {_md5("list_name || '|' || value", 1, 1200)} d1, {_md5("list_name || '|' || value", 5, 120)} x, {_md5("list_name || '|' || value", 9, 400)} y from v),
i as (select list_name, value, d1 since, d1 + 1 + x as until from n union all select list_name, value, d1 + 1 + x + 30 + y, 2147483647 from n),
c as (select rid, day, unnest(list_concat(
    list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda k: array_to_string(string_split(host, '.')[k:], '.')),
    list_transform(range(1, len(list_filter(string_split(path, '/'), lambda s: s <> '')) + 1),
      lambda k: host || '/' || array_to_string(list_filter(string_split(path, '/'), lambda s: s <> '')[1:k], '/')))) as value from a where host is not null),
m as (select rid, string_agg(distinct list_name, ',' order by list_name) lists, count(distinct list_name) n
  from c join i using (value) where since <= c.day and c.day < until group by rid)
select page_id, host, a.day fetch_day, coalesce(n, 0)::bigint n_lists, coalesce(lists, '') lists, n is not null blocked from a left join m using (rid)"""


# --- token shards --------------------------------------------------------------------

@query
def op3_token_shards(spark, sf_dir):
    return shards.materialise(table(spark, sf_dir, "documents"))


# --- language-model scores -----------------------------------------------------------

@query
def op2_lm_scores(spark, sf_dir):
    return lm.scores(table(spark, sf_dir, "documents"))


# --- repeated passages ---------------------------------------------------------------

@query
def op5_suffix_dedup(spark, sf_dir):
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


# --- near-duplicate passages ---------------------------------------------------------

@query
def op7_near_passages(spark, sf_dir):
    return windows.near_passages(table(spark, sf_dir, "documents"))


# --- hard negatives ------------------------------------------------------------------

@query
def op11_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


SQL["op11_hard_negatives"] = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l, list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id anchor_id, a.l al, b.vec_id id, b.l bl, list_dot_product(a.e, b.e)::bigint score from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, id positive_id, score positive_score from s where al = bl qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (select p.*, s.id negative_id, s.score negative_score, row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.id) rank
  from p join s on s.anchor_id = p.anchor_id and al <> bl and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, rank::int rank, negative_id, positive_score, negative_score from n where rank <= 3"""


# --- prefix trie ---------------------------------------------------------------------

@query
def op13_prefix_trie(spark, sf_dir):
    return tries.rebuilt_nodes(table(spark, sf_dir, "conversations"))


_TURN = "md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))"
_CRC = """xor(list_reduce(list_prepend(4294967295::ubigint, flatten(list_transform(string_split(conv_id::varchar, ''), lambda c: [ascii(c)::ubigint, 0, 0, 0, 0, 0, 0, 0]))),
  lambda v, e: case when xor(v, e) & 1 = 1 then xor(xor(v, e) >> 1, 3988292384::ubigint) else xor(v, e) >> 1 end), 4294967295::ubigint)"""
SQL["op13_prefix_trie"] = f"""
with o as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), {_TURN}) p, {_TURN} k, strlen(coalesce(text, '')) b from conversations where conv_id is not null),
c as (select conv_id, ({_CRC} % 9)::bigint h from (select distinct conv_id from o)),
opening as (select c.conv_id, p, k, b from c join o on o.conv_id = c.conv_id - c.conv_id % 5 and p <= h),
own as (select conv_id, p - h + coalesce(n, 0) p, k, b from o join c using (conv_id) left join (select conv_id, count(*) n from opening group by 1) using (conv_id) where p > h),
x as (select * from opening union all select * from own),
place as (select conv_id, 0 d, 0 b, '' k from c union all select conv_id, p, b, string_agg(k, '') over (partition by conv_id order by p) from x),
node as (select d, k, min(conv_id) conv_id, count(*) n_convs, any_value(b) b, left(k, 32 * greatest(d - 1, 0)) pk from place group by d, k),
kids as (select d - 1 d, pk k, count(*) n from node where d > 0 group by all),
parts as (select unnest(range(0, d + 1)) as top, node.k, node.d, (n_convs - 1) * b saved, n is null leaf from node left join kids using (d, k)),
sums as (select top as d, left(k, 32 * top) k, sum(saved) saved, count(*) filter (leaf) leaves from parts group by all),
done as (select k, string_agg(conv_id::varchar, ',' order by conv_id) ids from (select conv_id, arg_max(k, d) k from place group by 1) group by k)
select node.conv_id, node.d::bigint depth, up.conv_id parent_conv_id, node.n_convs, coalesce(kids.n, 0) n_children, leaves n_leaves, saved::bigint saved_tokens, sha256(coalesce(ids, '')) ends_sha256
from node join sums using (d, k) left join kids using (d, k) left join done using (k) left join node up on node.d > 0 and up.d = node.d - 1 and up.k = node.pk"""


# --- language identification ---------------------------------------------------------

@query
def op12_language_id(spark, sf_dir):
    return langid.identified(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
