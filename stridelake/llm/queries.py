"""The ``opN_`` queries: each operator over its whole table with production
parameters. Their results follow the digest columns of the operators' own,
richer outputs. SQL has those that DuckDB can express; the tests compare the
others with brute-force versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import documents
from .op1_jaccard_join import jaccard_join
from .op2_token_counts import token_counts
from .op3_quality import labels_table, quality
from .op4_bpe import encode_decode
from .op5_packing import pack
from .op6_quality_rules import quality_rules
from .op7_token_files import token_files
from .op8_language import language_id
from .op9_lm import lm_scores
from .op10_fingerprints import document_fingerprints
from .op11_collocations import collocations
from .op12_whitening import embeddings, whitening
from .op13_chat_format import chat_digest, conversations


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir)).drop("root")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), labels_table(spark, sf_dir)).select(
        "doc_id", "held_out", "score", "predicted")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without ``rejected_by``: it names the first rule in measured order."""
    return quality_rules(documents(spark, sf_dir)).drop("rejected_by")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(embeddings(spark, sf_dir))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digest(conversations(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_jaccard_join, op2_token_counts, op3_quality, op4_bpe, op5_packing, op6_quality_rules,
        op7_token_files, op8_language, op9_lm, op10_fingerprints, op11_collocations,
        op12_whitening, op13_chat_format)
}

#: The rules' verdict does not depend on their order, so SQL can say it whole; so can it
#: the phrases' counts and scores, and what the chat template gives back.
SQL: dict[str, str] = {
    "op6_quality_rules": r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), w as (
  select r, doc_id, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))
           as lines
  from d
), windows as (
  select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g
  from (select r, words, unnest(range(1, len(words) - 1)) as i from w)
), twice as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1
), covered as (
  select r, count(distinct p) as n from (
    select r, unnest([i, i + 1, i + 2]) as p from twice) group by r
), s as (
  select w.r, doc_id, len(words) as n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         length(regexp_replace(text, '[^!]', '', 'g')) as n_bangs,
         len(lines) as n_lines,
         len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(covered.n, 0) as n_repeat_words
  from w left join covered using (r)
), v as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from s
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > 4 * word_chars or 100 * n_dup_lines > 50 * n_lines
            or word_chars < 2 * n_words or word_chars > 20 * n_words
            or 100 * n_bangs > 25 * n_words) as kept
from v
""",
    "op11_collocations": r"""
with d as (
  select row_number() over () as doc, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           as text
  from documents
), pieces as (
  select row_number() over () as p, lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from d)
), places as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from pieces
), f as (
  select lang, k, phrase, count(*) as f from (
    select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
    from places, (select unnest([1, 2, 3, 4, 5]) as k) where i + k - 1 <= len(w))
  group by all having count(*) >= 100
), n as (
  select lang, count(*) as n from places group by lang
), c as (
  select lang, phrase, k, f as a, string_split(phrase, ' ') as w from f where k > 1
), covered as (
  select distinct c.lang, c.phrase from c join c as b
  on b.lang = c.lang and b.k > c.k and contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')
     and 100 * b.a >= 100 * c.a
), cuts as (
  select c.lang, c.phrase, c.a, n.n, cut, x.f as l, y.f as r,
         ((1000::hugeint * c.a * n.n) // (x.f::hugeint * y.f))::bigint as score
  from (select *, unnest(range(1, k)) as cut from c) as c join n using (lang)
  join f as x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:cut], ' ')
  join f as y on y.lang = c.lang and y.phrase = array_to_string(c.w[cut + 1:], ' ')
), best as (
  select * from cuts anti join covered using (lang, phrase)
  qualify row_number() over (partition by lang, phrase order by score, cut) = 1
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, n, score
from best
qualify rank <= 2000
""",
    "op13_chat_format": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), w as (
  select *, regexp_matches(text, '<\|im_(start|end)\|>|<\\+\|')
         or regexp_matches(role, '<\|im_(start|end)\|>|<\|nl\|>|<\\+\||\n') as conflicts
  from t
), s as (
  select *, 12 + length(role) + 1 + length(text) + 10 + 1 + if(conflicts,
         len(regexp_extract_all(role || ' ' || text, '<\\*\|')) + 5 * len(regexp_extract_all(role, '\n')),
         0) as written
  from w
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
              order by turn nulls last, role, text)) as turns_sha256,
       sum(if(role = 'assistant', length(text), 0))::bigint as loss_chars,
       sha256(string_agg(if(role = 'assistant', text, ''), ''
              order by turn nulls last, role, text)) as loss_sha256,
       sum(written)::bigint as formatted_chars
from s group by conv_id
""",
}
