"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import (
    bpe, conversations, embed, html, langid, linededup, lm, minhash, packing, phrases, quality, tokencount, toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under near duplication (five-word shingles, 0.8)."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule ledger of every document with the base and the current verdict."""
    return quality.quality(_table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document, encoded and decoded again."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log-probability of every document."""
    return lm.score_texts(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines after corpus-wide line dedup, as counts and a digest."""
    return linededup.line_dedup_digest(_table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.main_text(_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label."""
    return embed.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's collocations of two to five words, by the score of their weakest cut."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair as edits and a digest."""
    rows = _table(spark, sf_dir, "conversations")
    return conversations.report(rows, conversations.damage(rows))


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_quality, op3_bpe, op4_langid, op5_lm, op6_packing, op7_line_dedup, op8_html,
    op9_toxicity, op10_embeddings, op11_phrases, op12_token_counts, op13_conversations)}

_OP2 = r"""
with t as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
m as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from t),
grams as (
  select r, unnest(range(1, len(w) - 6)) as i, w from m where len(w) >= 8),
keyed as (select r, i, list_slice(w, i, i + 7) as g from grams),
twice as (select r, g from keyed group by r, g having count(*) > 1),
spots as (select distinct k.r, unnest(range(k.i, k.i + 8)) as p from keyed k join twice using (r, g)),
covered as (select r, count(distinct p) as n from spots group by r),
measured as (
  select m.doc_id, len(w)::bigint as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words,
    (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::bigint as n_upper,
    len(lines)::bigint as n_lines,
    length(regexp_replace(text, '[^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]', '', 'g'))::bigint as n_unspaced
  from m left join covered using (r)),
bits as (
  select *,
    case when n_words < 20 then 1 else 0 end
    + case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end
    + case when 10 * n_symbols > 3 * n_words then 4 else 0 end
    + case when 2 * n_dup_lines > n_lines then 8 else 0 end
    + case when 2 * n_upper > word_chars then 16 else 0 end
    + case when word_chars < 2 * n_words or word_chars - n_unspaced > 20 * n_words then 32 else 0 end as failed
  from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & 3 <> 0 as base_failed, failed = 0 as kept, failed::bigint as failed
from bits
"""

_OP7 = r"""
with t as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
lines as (
  select doc_id, r, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) as pos from t),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
hot as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20 and doc_id is not null
  group by key having count(distinct doc_id) >= 3),
marked as (
  select k.*, coalesce(hot.keeper <> k.doc_id, false) as gone from keyed k left join hot using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by r, doc_id
"""

_OP1 = r"""
with recursive t as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (
  select distinct doc_id, list_slice(w, i, i + 4) as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from t where len(w) > 0)),
n as (select doc_id, count(*) as n from g group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from g a join g b on a.s = b.s and a.doc_id < b.doc_id group by all),
link as (
  select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where c >= 0.8 * (x.n + y.n - c)),
pairs as (select a, b from link union select b, a from link),
reach as (select doc_id as v, doc_id as r from documents union select reach.v, pairs.b from reach join pairs on pairs.a = reach.r),
cls as (select v, min(r) as class_id from reach group by v)
select doc_id, class_id, doc_id = class_id as kept, coalesce(n, 0)::bigint as n_shingles
from documents join cls on v = doc_id left join n using (doc_id)
"""

_OP10 = r"""
with recursive v as (
  select vec_id, label, embedding::double[] as e, list_sum(list_transform(embedding::double[], lambda x: x * x)) as q
  from embeddings),
ok as (
  select * from v where vec_id is not null and label is not null and q > 0 and isfinite(q)
  and len(list_filter(e, lambda x: x is null)) = 0),
link as (
  select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_inner_product(a.e, b.e) / sqrt(a.q * b.q) >= 0.98),
reach as (select vec_id as v, vec_id as r from embeddings union select reach.v, link.b from reach join link on link.a = reach.r),
comp as (select v, min(r) as c from reach group by v),
many as (select a, count(*) as n from link group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, c as component_id, vec_id = c as kept
from embeddings join comp on v = vec_id left join many on a = vec_id
"""

_OP11 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
total as (select lang, sum(len(w))::bigint as n from w group by lang),
spelled as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) as phrase
  from w, (select unnest(range(1, 6)) as k) where len(w) >= k),
f as (select lang, k, phrase, count(*)::bigint as f from spelled group by all having count(*) >= 100),
cuts as (
  select c.lang, c.k, c.phrase, c.f as a, j, total.n, string_split(c.phrase, ' ') as ws
  from f c join total using (lang), (select unnest(range(1, 5)) as j) where c.k >= 2 and j < c.k),
scored as (
  select cuts.*, l.f as l, r.f as r, (1000::hugeint * a * n) // (l.f::hugeint * r.f) as score
  from cuts join f l on l.lang = cuts.lang and l.phrase = array_to_string(list_slice(ws, 1, j), ' ')
  join f r on r.lang = cuts.lang and r.phrase = array_to_string(list_slice(ws, j + 1, cuts.k), ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
kept as (
  select * from best where not exists (
    select 1 from f longer where longer.lang = best.lang and longer.k > best.k and longer.f >= best.a
    and contains(' ' || longer.phrase || ' ', ' ' || best.phrase || ' '))),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a, l, r, n, score::bigint as score from ranked where rank <= 2000
"""

SQL = {"op1_minhash": _OP1, "op10_embeddings": _OP10, "op11_phrases": _OP11, "op2_quality": _OP2, "op7_line_dedup": _OP7}
