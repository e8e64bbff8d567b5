"""The registered queries of this package, each over its whole table, and their SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sentrail.llm import (
    alignment,
    collocations,
    decontamination,
    license_scan,
    packing,
    parity_join,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    token_counts,
    token_files,
    toxicity,
)
from sentrail.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_rules.quality_report(_table(spark, sf_dir, "documents"))
    return report.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op4_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.line_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token_ids")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digests(token_files.read_tokens(spark, folder))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment_report(_table(spark, sf_dir, "documents"), *paths)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_best_fit_packing,
        op3_quality_rules,
        op4_parity_join,
        op5_sharding,
        op6_quality_classifier,
        op7_license_scan,
        op8_decontamination,
        op9_token_counts,
        op10_token_files,
        op11_collocations,
        op12_alignment,
        op13_simhash,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BY_SPACE = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

_WORDS = r"[^\x20\x09-\x0D]+"
_RATES = {
    "symbol_rate": "n_symbols * 10000 // greatest(word_chars, 1)",
    "repeat_rate": "n_repeat_words * 10000 // greatest(n_words, 1)",
    "line_repeat_rate": "n_dup_lines * 10000 // greatest(n_lines, 1)",
    "capital_rate": "n_capitals * 10000 // greatest(word_chars, 1)",
    "word_length": "word_chars * 100 // greatest(n_words, 1)",
}


def _quartiles(keys: str) -> str:
    """Total and quartiles of every measure of the groups by ``keys``."""
    by = f"{keys}, measure" if keys else "measure"
    return f"""(select {by}, max(c) total, min(v) filter (rn * 4 >= c) q1, min(v) filter (rn * 4 >= c * 3) q3 from (
      select {by}, v, row_number() over (partition by {by} order by v) rn, count(*) over (partition by {by}) c from passed) group by {by})"""


def _blended(own: str, above: str, same: str) -> str:
    parts = [f"(o.total * o.{q} + {quality_rules.PRIOR} * u.{q}) // (o.total + {quality_rules.PRIOR}) as {q}" for q in ("q1", "q3")]
    return f"(select o.* exclude (q1, q3), {', '.join(parts)} from {own} o join {above} u on o.measure = u.measure{same})"


_LANG = _blended(_quartiles("lang"), _quartiles(""), "")
_GROUP = _blended(_quartiles("lang, source"), _LANG, " and o.lang is not distinct from u.lang")

#: SQL where it can tell the result; the others rest on fitted models, sketches, hashed draws or tokenizers
ORACLE: dict[str, str] = {
    "op3_quality_rules": f"""with texts as (select row_number() over () r, doc_id, lang, source, coalesce(text, '') t from documents),
      cut as (select *, regexp_extract_all(t, '{_WORDS}') w, [l for l in string_split(t, chr(10)) if regexp_matches(l, '{_WORDS}')] l from texts),
      base as (select r, doc_id, lang, source, w, len(w) n_words, length(array_to_string(w, '')) word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) n_symbols, len(l) - len(list_distinct(l)) n_dup_lines, len(l) n_lines,
        len(regexp_extract_all(t, '[A-Z]')) n_capitals from cut),
      places as (select r, unnest(range(1, len(w) - 1)) p, unnest([array_to_string(w[i : i + 2], ' ') for i in range(1, len(w) - 1)]) g
        from base where len(w) > 2),
      windows as (select r, p, count(*) over (partition by r, g) n from places),
      repeats as (select r, count(distinct q) c from (select r, unnest(range(p, p + 3)) q from windows where n > 1) group by r),
      facts as (select base.*, coalesce(c, 0) n_repeat_words from base left join repeats using (r)),
      judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from facts),
      rates as ({" union all ".join(f"select r, lang, source, base_failed, '{name}' measure, {rate} x, {quality_rules.SPREAD[name]} spread from judged" for name, rate in _RATES.items())}),
      passed as (select lang, source, measure, x - x % (1 << greatest(length(bin(x)) - 7, 0)) v from rates where not base_failed),
      fences as (select * from {_GROUP}),
      beyond as (select r from rates x join fences f on x.measure = f.measure and x.lang is not distinct from f.lang and x.source is not distinct from f.source
        group by r having bool_or(x > q3 + {quality_rules.REACH} * greatest(q3 - q1, spread)))
      select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and r not in (select r from beyond) kept from judged""",
    "op4_parity_join": f"""with recursive words as (select doc_id, {_BY_SPACE} w from documents),
      placed as (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) p from words where len(w) > 0),
      shingles as (select distinct doc_id, array_to_string(w[p : p + 3], ' ') g from placed),
      sizes as (select doc_id, count(*) n from shingles group by all),
      common as (select a.doc_id a, b.doc_id b, count(*) c from shingles a join shingles b using (g)
        where a.doc_id <> b.doc_id group by all),
      links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
        where 100 * c >= 85 * (x.n + y.n - c)),
      reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a)
      select doc_id, coalesce(n, 0) n_shingles, least(doc_id, coalesce(m, doc_id)) component_id
      from words left join sizes using (doc_id) left join (select a doc_id, min(b) m from reach group by all) using (doc_id)""",
    "op11_collocations": f"""with pieces as (select coalesce(lang, 'und') lang,
        unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) piece from documents),
      words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces),
      totals as (select lang, cast(sum(len(w)) as bigint) n from words group by all),
      places as (select lang, w, k, unnest(range(1, len(w) - k + 2)) p from words, (select unnest(range(1, 5)) k) where len(w) >= k),
      counts as (select lang, k, array_to_string(w[p : p + k - 1], ' ') g, count(*) f from places group by all having count(*) >= 30),
      covered as (select distinct a.lang, a.g from counts a join counts b on a.lang = b.lang and b.k > a.k
        and contains(' ' || b.g || ' ', ' ' || a.g || ' ') and 100 * b.f >= 80 * a.f where a.k > 1),
      cuts as (select lang, g, f, string_split(g, ' ') w, unnest(range(1, k)) c from counts where k > 1 and (lang, g) not in (select (lang, g) from covered)),
      parts as (select cuts.lang, cuts.g, cuts.f, c, x.f l, y.f r, 2000000::hugeint * cuts.f // (x.f + y.f) s from cuts
        join counts x on x.lang = cuts.lang and x.g = array_to_string(w[: c], ' ')
        join counts y on y.lang = cuts.lang and y.g = array_to_string(w[c + 1 :], ' ')),
      scored as (select * from parts qualify row_number() over (partition by lang, g order by s, c) = 1),
      ranked as (select *, row_number() over (partition by lang order by s desc, f desc, encode(g)) place from scored)
      select lang, place as rank, g phrase, f a, l, r, n, cast(s as bigint) score from ranked join totals using (lang) where place <= 2000""",
    "op8_decontamination": f"""with docs as (select doc_id, {_ALNUM} w from documents),
      items as (select cast(item_id as varchar) item, {_ALNUM} w from benchmark),
      starts as (select item, w, least(13, len(w)) k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) p from items where len(w) > 0),
      windows as (select distinct item, k, array_to_string(w[p : p + k - 1], ' ') g from starts),
      places as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) p
        from docs, (select distinct k from windows) where len(w) >= k),
      found as (select doc_id, p, k, item from (select doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') g from places)
        join windows using (k, g)),
      hits as (select doc_id, count(*) n_hit from (select distinct doc_id, unnest(range(p, p + k)) from found) group by all),
      named as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) ids
        from (select distinct doc_id, item from found) group by all)
      select doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
        sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) contaminated
      from docs left join hits using (doc_id) left join named using (doc_id)""",
}
