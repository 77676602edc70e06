"""One query for each operator, over its whole table, and the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.llm import (
    collocations,
    decontaminate,
    hard_negatives,
    license_scan,
    line_dedup,
    ngram_join,
    personal_data,
    quality_ratio,
    simhash_groups,
    source_mix,
    suffix_dedup,
    toxicity,
    url_filter,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    trusted = quality_ratio.trusted_ids(table(spark, sf_dir, "labels"))
    return quality_ratio.score_documents(table(spark, sf_dir, "documents"), trusted)


def op2_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_source_mix(spark, sf_dir):
    mixed = source_mix.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_ngram_join(spark, sf_dir):
    return ngram_join.group_similar(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    network = toxicity.fit_network(documents, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(documents.select("doc_id", "text"), network).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_decontamination(spark, sf_dir):
    return decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op7_personal_data(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return personal_data.find_personal_data(documents, personal_data.fit_field(documents))


def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_url_filter(spark, sf_dir):
    """The list grows with the table: the canonical URLs of every twentieth page."""
    pages = table(spark, sf_dir, "pages")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    listed = pages.filter("page_id % 20 = 0").select(url_filter.canonical(host, path).alias("url"))
    judged = url_filter.judge_urls(pages, url_filter.rule_table(spark), listed)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_line_dedup(spark, sf_dir):
    cleaned = line_dedup.remove_lines(
        table(spark, sf_dir, "documents"), n_lines="n_lines", n_removed="n_removed"
    )
    return cleaned.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op11_simhash_dedup(spark, sf_dir):
    return simhash_groups.group_near(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    """Labels of every seventh row are moved on by one, so that near rows of other labels exist."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_license_scan": op2_license_scan,
        "op3_source_mix": op3_source_mix,
        "op4_ngram_join": op4_ngram_join,
        "op5_toxicity": op5_toxicity,
        "op6_decontamination": op6_decontamination,
        "op7_personal_data": op7_personal_data,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_url_filter": op9_url_filter,
        "op10_line_dedup": op10_line_dedup,
        "op11_simhash_dedup": op11_simhash_dedup,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_collocations": op13_collocations,
    }


# --- the same in SQL ------------------------------------------------------------------------------

_WORD = r"[^\x20\x09-\x0D]+"


def _license_sql() -> str:
    rows = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(license_scan.TEMPLATES))
    notice = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = f"translate({{0}}, '{license_scan_upper}', '{license_scan_lower}')"
    phrases = ", ".join(
        f"('{label}', {[*phrase.split(' ')]})" for phrase, label in license_scan.PHRASES.items()
    )
    return rf"""
with templates as (
 select t, label, len(ws) as width, list_distinct(ws) as tokens
 from (select t, label, regexp_extract_all({low.format('body')}, '{notice}') as ws from (values {rows}) v(t, label, body))
), w as (
 select row_number() over () as r, doc_id, regexp_extract_all({low.format("coalesce(text, '')")}, '{notice}') as words
 from documents
), phrases as (select * from (values {phrases}) p(label, parts)),
places as (
 select r, label, pos from (
  select r, words, unnest(range(len(words))) as pos from w) s, phrases
 where list_slice(words, pos + 1, pos + len(parts)) = parts
), base as (
 select r, count(*) as n, min(pos) as a, max(pos) as z, list(distinct label) as found from places group by r
), blocks as (
 select r, label, tokens, list_slice(words, s, s + 2 * width - 1) as block from (
  select r, words, t, label, tokens, width, unnest(range(1, greatest(len(words) - width, 1) + 1, width)) as s
  from w, templates) x
), met as (
 select r, label, len(list_intersect(tokens, block)) / len(tokens) as share from blocks
 where len(list_intersect(tokens, block)) >= ceil(round({license_scan.THRESHOLD} * len(tokens), 9))
), best as (select r, list(distinct label) as found, max(share) as score from met group by r)
select w.doc_id, len(words)::bigint as n_words, coalesce(n, 0) as n_base, a as first_word, z as last_word,
 coalesce(array_to_string(list_sort(base.found), ','), '') as base_labels,
 coalesce(array_to_string(list_sort(list_distinct(list_concat(base.found, best.found))), ','), '') as labels,
 coalesce(score, 0)::double as score
from w left join base using (r) left join best using (r)"""


license_scan_upper, license_scan_lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MIX_SQL = rf"""
with d as (
 select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size,
  -ln((('0x' || substr(md5(concat_ws(chr(31), 'mix', coalesce(doc_id::varchar, ''))), 1, 13))::bigint + 0.5)
   / {float(1 << source_mix.UNIFORM_BITS)})
  / greatest(0.5 + coalesce(length(translate(coalesce(text, ''), '#*$%&|<>', ''))
   / nullif(length(coalesce(text, '')), 0), 0.0) / 2.0, 1e-6) as k
 from documents
), s as (
 select source, sum(size)::bigint as source_size,
  [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
 from d group by source
), r as (select *, source_size * 2 as most, source_size * 2 / weight as ratio from s),
l as (
 select *, (sum(source_size) over () * 1.5::double
   - coalesce(sum(most) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0))
  / (sum(weight) over ()
   - coalesce(sum(weight) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0))
  as level from r
), t as (
 select source, source_size,
  least(most::double, weight * coalesce(max(case when ratio >= level then level end) over (), 0.0)) as target from l
), p as (
 select d.*, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as epochs,
  sum(size) over (partition by d.source order by k, doc_id rows unbounded preceding) - size as before
 from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
 (epochs * size + greatest(0, least(size, floor(target)::bigint - epochs * source_size - before)))::bigint as taken
from p"""

_URL_SQL = r"""
with u as (
 select page_id, coalesce(translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
  coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*(/[^?#]*)', 1), '') as path
 from pages
), c as (
 select row_number() over () as r, *, regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^www\.', '')
  || regexp_replace(path, '/+$', '') as canonical from u
), rules as (
 select verdict, rule, rule.substr(1, position('/' in rule) - 1) as rhost, rule.substr(position('/' in rule)) as rpath
 from (values ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
  ('allow', 'com/fr/'), ('block', 'com/de/')) v(verdict, rule)
), hits as (
 select r, arg_max(rule, length(rule) * 1000 + length(rhost)) as rule,
  arg_max(verdict, length(rule) * 1000 + length(rhost)) as verdict
 from c, rules where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by r
)
select page_id, host, path, rule, coalesce(verdict,
 case when canonical in (select canonical from c where page_id % 20 = 0) then 'block' else 'allow' end) as verdict
from c left join hits using (r)"""

_LINE_SQL = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(source, chr(0)) as site,
 string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (
 select r, site, unnest(lines) as line, generate_subscripts(lines, 1) as pos from d
), k as (
 select *, case when regexp_matches(line, '{_WORD}') then trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) end as key
 from l
), bad as (
 select key from k where key is not null group by key having count(distinct site) >= {line_dedup.MIN_SITES}
), marked as (select k.*, coalesce(k.key in (select key from bad), false) as is_bad from k),
kept as (
 select r, count(key) as n_lines, count(*) filter (where is_bad) as n_removed,
  coalesce(string_agg(line, chr(10) order by pos) filter (where not is_bad), '') as body from marked group by r
)
select doc_id, n_lines, n_removed, sha256(body) as kept_sha256 from d join kept using (r)"""


_NEGATIVE_SQL = f"""
with e as (
 select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::double)) as v
 from embeddings
 where label is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
 select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
 from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), p as (
 select anchor_id, id as positive_id, score as positive_score from s where same
 qualify row_number() over (partition by anchor_id order by score desc, id) <= {hard_negatives.POSITIVES}
)
select anchor_id, positive_id,
 row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank,
 id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and {hard_negatives.NEAR} * positive_score <= 100 * score and score <= positive_score
qualify rank <= {hard_negatives.NEGATIVES}"""


def _collocation_sql() -> str:
    low = f"translate(coalesce(text, ''), '{license_scan_upper}', '{license_scan_lower}')"
    words = collocations.MAX_WORDS
    grams = " union all ".join(
        f"select lang, {n} as words, array_to_string(list_slice(ws, i, i + {n - 1}), ' ') as phrase"
        f" from (select lang, ws, unnest(range(1, len(ws) - {n - 2})) as i from w)"
        for n in range(1, words + 1)
    )
    cuts = " union all ".join(
        f"select c.*, {k} as k, array_to_string(list_slice(ps, 1, {k}), ' ') as lp,"
        f" array_to_string(list_slice(ps, {k + 1}, words), ' ') as rp from cand c where words > {k}"
        for k in range(1, words)
    )
    return rf"""
with w as (
 select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from (
  select coalesce(lang, '{collocations.NO_LANGUAGE}') as lang,
   unnest(string_split_regex({low}, '[.,;:!?\x0A-\x0D]')) as piece from documents)
), sizes as (select lang, sum(len(ws))::hugeint as n from w group by lang),
f as (
 select lang, words, phrase, count(*) as a from ({grams}) group by all having count(*) >= {collocations.MIN_COUNT}
), cand as (select *, string_split(phrase, ' ') as ps from f where words > 1),
cuts as ({cuts}),
scored as (
 select c.lang, c.phrase, c.words, c.a, n, l.a as l, r.a as r, (1000::hugeint * c.a * n) // (l.a::hugeint * r.a) as score,
  row_number() over (partition by c.lang, c.phrase
   order by (1000::hugeint * c.a * n) // (l.a::hugeint * r.a), k) as cut
 from cuts c join f l on l.lang = c.lang and l.phrase = lp join f r on r.lang = c.lang and r.phrase = rp
  join sizes s on s.lang = c.lang
), inside as (
 select lang, array_to_string(list_slice(ps, i, i + m - 1), ' ') as phrase, max(a) as longer
 from (select *, unnest(range(1, words - m + 2)) as i from (select *, unnest(range(2, words)) as m from cand)) group by all
), kept as (
 select s.* from scored s left join inside i on i.lang = s.lang and i.phrase = s.phrase
 where cut = 1 and coalesce(100 * longer < {collocations.ABSORBED} * a, true)
)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from (
 select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
where rank <= {collocations.MOST}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": _license_sql(),
        "op3_source_mix": _MIX_SQL,
        "op9_url_filter": _URL_SQL,
        "op10_line_dedup": _LINE_SQL,
        "op12_hard_negatives": _NEGATIVE_SQL,
        "op13_collocations": _collocation_sql(),
    }
