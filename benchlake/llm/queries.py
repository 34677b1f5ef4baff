"""The registered queries of the training-data operators, and their DuckDB SQL where it exists."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.llm import (alignment, decontam, html_text, jaccard_join, line_dedup, online_packing, packing, pii, quality,
                           secrets, sharding, spelling, url_filter)

#: The rules of op9, (verdict, host and path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, with the item and the edits."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt to 24 shards by jump consistent hashing."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat across documents, as counts and a digest."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at a Jaccard similarity of 0.8 of word 5-grams."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their spelling variants."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers on every document."""
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed online into sequences of 2048 tokens."""
    return online_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {
    "op1_decontamination": op1,
    "op2_packing": op2,
    "op3_html_text": op3,
    "op4_secrets": op4,
    "op5_sharding": op5,
    "op6_line_dedup": op6,
    "op7_jaccard_join": op7,
    "op8_quality_rules": op8,
    "op9_url_filter": op9,
    "op10_pii": op10,
    "op11_spelling_variants": op11,
    "op12_token_alignment": op12,
    "op13_online_packing": op13,
}

ORACLE_SQL = {
    "op6_line_dedup": r"""
        with lines as (
            select doc_id, t.line, t.pos, translate(trim(t.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from documents, lateral (select unnest(string_split(coalesce(text, ''), chr(10))) as line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos) t),
        repeated as (
            select key, max(doc_id) as holder from lines where length(key) >= 20
            group by key having count(distinct doc_id) >= 3),
        judged as (
            select l.*, r.key is not null and l.doc_id <> r.holder as gone from lines l left join repeated r using (key))
        select doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
        from judged group by doc_id""",
    "op9_url_filter": r"""
        with parts as (
            select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages),
        split as (
            select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
        rules(rule, rhost, rpath, verdict) as (values
            ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
            ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
            ('net/fr/', 'net', '/fr/', 'block')),
        fits as (
            select s.*, r.rule, r.verdict,
                   row_number() over (partition by page_id order by length(r.rule) desc) as k
            from split s left join rules r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where k = 1""",
    "op11_spelling_variants": r"""
        with recursive
        table8(byte, c, step) as (
            select i, i, 0 from range(256) t(i)
            union all select byte, xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end), step + 1 from table8 where step < 8),
        bytes as (select byte, c as one from table8 where step = 8),
        runs as (
            select doc_id, run, count(*) as times from (
                select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
                from documents)
            where length(run) >= 5 group by all),
        coded as (select *, row_number() over () as id, hex(encode(doc_id || ':' || run)) as code from runs),
        longest as (select max(length(code) // 2) as most from coded),
        -- what a byte adds to the CRC when d bytes follow it; and the register after d zero bytes
        shifted(byte, d, c) as (
            select byte, 0, one from bytes
            union all select s.byte, d + 1, xor(s.c >> 8, b.one) from shifted s join bytes b on b.byte = s.c & 255, longest where d + 1 < most),
        zeros(d, c) as (
            select 0, 4294967295
            union all select d + 1, xor(z.c >> 8, b.one) from zeros z join bytes b on b.byte = z.c & 255, longest where d < most),
        letters as (
            select id, length(code) // 2 as size, unnest(range(length(code) // 2)) as pos, unnest(regexp_extract_all(code, '..')) as pair from coded),
        hashed as (
            select l.id, xor(xor(bit_xor(s.c), any_value(z.c)), 4294967295) as h
            from letters l join shifted s on s.byte = ('0x' || l.pair)::int and s.d = l.size - 1 - l.pos join zeros z on z.d = l.size group by l.id),
        made as (
            select case when h % 97 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, times
            from coded join hashed using (id)),
        words as (select word, sum(times)::bigint as n from made where length(word) >= 5 group by word having sum(times) >= 3),
        cut as (
            select word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) as rest
            from (select word, n, unnest(range(1, length(word) + 1)) as p from words)),
        near as (
            select a.word, a.n, b.word as near, b.n as near_n from cut a join cut b on a.p = b.p and a.rest = b.rest and a.word <> b.word
            union select a.word, a.n, b.word, b.n from cut a join words b on a.rest = b.word
            union select b.word, b.n, a.word, a.n from cut a join words b on a.rest = b.word),
        ranked as (
            select word, n, near, near_n, count(*) over (partition by word) as n_near, row_number() over (partition by word order by near_n desc, near) as k
            from near),
        judged as (
            select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 2 * w.n then near end as form, case when near_n >= 2 * w.n then near_n end as form_n
            from words w left join ranked r on r.word = w.word and k = 1),
        chain(word, last) as (
            select word, word from words
            union all select c.word, j.form from chain c join judged j on j.word = c.last where j.form is not null),
        ends as (select c.word, c.last as root from chain c join judged j on j.word = c.last where j.form is null)
        select j.word, form, root, n, n_near, form_n from judged j join ends using (word)""",
}
