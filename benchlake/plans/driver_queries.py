"""Every operator as a query over the driver's tables, with its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` describe the same result:
identical column names, comparable types.  Keys without an oracle entry are checked rows-only
(plus unit tests against hand-written fixtures and brute force).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from benchlake.operators.order_stats import exact_median
from benchlake.operators import marts
from benchlake.plans import adapters as A
from benchlake.plans.adapters import QUESTIONS_SQL as Q
from benchlake.plans.adapters import RESPONSES_SQL as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


ACC_SQL = "round(avg(case when ai_correct then 1.0::double else 0.0::double end), 4)"

# ------------------------------------------------------------------ marts (AGG-1..5, JOIN-1)


@register("model_performance", f"""
select model_name, count(*) as n_responses,
       cast(sum(case when ai_correct then 1 else 0 end) as bigint) as n_correct,
       {ACC_SQL} as accuracy,
       round(avg(response_time), 2) as latency_mean_s,
       round(median(response_time), 2) as latency_median_s
from {R} r group by model_name""")
def q_model_performance(spark, sf):
    return marts.model_performance(A.responses(spark, sf))


@register("prompt_performance", f"""
select model_name, prompt_variant, count(*) as n_responses, {ACC_SQL} as accuracy,
       round(avg(response_time), 2) as latency_mean_s
from {R} r group by model_name, prompt_variant""")
def q_prompt_performance(spark, sf):
    return marts.prompt_performance(A.responses(spark, sf))


@register("response_time", f"""
select model_name, prompt_variant,
       round(min(response_time), 2) as latency_min_s, round(avg(response_time), 2) as latency_mean_s,
       round(median(response_time), 2) as latency_median_s, round(max(response_time), 2) as latency_max_s
from {R} r group by model_name, prompt_variant""")
def q_response_time(spark, sf):
    return marts.response_time(A.responses(spark, sf))


@register("exact_median", """
select l_linestatus, l_returnflag, median(l_extendedprice) as median_price from lineitem group by l_linestatus, l_returnflag""")
def q_exact_median(spark, sf):
    """Exact medians of a continuous column."""
    return exact_median(A.table(spark, sf, "lineitem"), ["l_linestatus", "l_returnflag"], "l_extendedprice", "median_price")


@register("responses_enriched", f"""
select r.question_id, r.model_name, r.prompt_variant, r.ai_answer, r.ai_correct, r.response_time,
       q.category, q.type as question_type, q.difficulty
from {R} r inner join {Q} q using (question_id)""")
def q_responses_enriched(spark, sf):
    return marts.responses_enriched(A.responses(spark, sf), marts.stg_questions(A.questions(spark, sf)))


@register("category_accuracy", f"""
select q.category, r.model_name, r.prompt_variant, count(*) as n_responses, {ACC_SQL} as accuracy
from {R} r inner join {Q} q using (question_id) group by 1, 2, 3""")
def q_category_accuracy(spark, sf):
    return marts.category_accuracy(A.responses(spark, sf), A.questions(spark, sf))


@register("difficulty_accuracy", f"""
select q.difficulty, r.model_name, r.prompt_variant, count(*) as n_responses, {ACC_SQL} as accuracy
from {R} r inner join {Q} q using (question_id) group by 1, 2, 3""")
def q_difficulty_accuracy(spark, sf):
    return marts.difficulty_accuracy(A.responses(spark, sf), A.questions(spark, sf))


@register("stg_questions", f"""
select question_id, category, type as question_type, difficulty, question, correct_answer from {Q} q""")
def q_stg_questions(spark, sf):
    return marts.stg_questions(A.questions(spark, sf))


# ------------------------------------------------------------------ SQL helpers for the oracle

from pyspark.sql import functions as F  # noqa: E402

from benchlake.functions import grading, prompts  # noqa: E402
from benchlake.functions import text as T  # noqa: E402
from benchlake.operators import coverage, inference, quality, sampling, views, worklist  # noqa: E402
from benchlake.plans import flows, silver  # noqa: E402
from benchlake.plans.adapters import BRONZE_SQL as B  # noqa: E402
from benchlake.sources import bronze as bronze_src  # noqa: E402
from benchlake.sources import files  # noqa: E402
from benchlake.streaming import merge  # noqa: E402

WS = T.WS


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def norm_sql(x: str) -> str:
    arts = ", ".join(f"'{a}'" for a in T.ARTICLES)
    cleaned = rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_{WS}]', '', 'g')"
    return (f"array_to_string(list_filter(regexp_split_to_array({cleaned}, '[{WS}]+'), "
            f"lambda w: w <> '' and w not in ({arts})), ' ')")


def grade_sql(na: str, nc: str) -> str:
    tw = ", ".join(f"'{w}'" for w in grading.TRUE_WORDS)
    fw = ", ".join(f"'{w}'" for w in grading.FALSE_WORDS)
    return (f"case when {nc} = 'true' then list_has_any(string_split({na}, ' '), [{tw}]) "
            f"when {nc} = 'false' then list_has_any(string_split({na}, ' '), [{fw}]) "
            f"else ({nc} <> '' and contains({na}, {nc})) end")


def sql_lit(s: str) -> str:
    """A SQL string literal (newlines as chr(10), quotes doubled)."""
    parts = [("'" + p.replace("'", "''") + "'") for p in s.split("\n")]
    return " || chr(10) || ".join(parts)


OVERVIEW_MODELS, OVERVIEW_VARIANTS = ["O"], ["naive", "role_expert"]
COMPARE_MODELS = ["F"]
RUN_MODEL = "O"
DONE_MODEL = "model-a"
SAMPLE_N, SAMPLE_SEED = 300, 42
LANGS = ["de", "en", "es", "fr"]
ACC_RAW = "avg(case when ai_correct then 1.0::double else 0.0::double end)"
E_SQL = f"(select r.*, q.category, q.difficulty, q.type as question_type from {R} r join {Q} q using (question_id))"


def _in(vals):
    return ", ".join(f"'{v}'" for v in vals)


# ------------------------------------------------------------------ dashboard views (AGG-6..14)


@register("overview_kpis", f"""
select count(*) as n_responses, {ACC_RAW} as accuracy, avg(response_time) as latency_mean_s
from {R} r where model_name in ({_in(OVERVIEW_MODELS)}) and prompt_variant in ({_in(OVERVIEW_VARIANTS)})""")
def q_overview_kpis(spark, sf):
    return views.overview_kpis(A.responses(spark, sf), OVERVIEW_MODELS, OVERVIEW_VARIANTS)


@register("overview_by_model", f"""
select model_name, {ACC_RAW} as accuracy, count(*) as n, avg(response_time) as latency_mean_s,
       row_number() over (order by {ACC_RAW}, model_name) as accuracy_order,
       row_number() over (order by avg(response_time), model_name) as latency_order
from {R} r group by model_name""")
def q_overview_by_model(spark, sf):
    return views.overview_by_model(A.responses(spark, sf))


@register("category_by_model", f"""
select category, model_name, {ACC_RAW} as accuracy, count(*) as n,
       row_number() over (order by {ACC_RAW} desc, category, model_name) as display_order
from {E_SQL} e group by category, model_name""")
def q_category_by_model(spark, sf):
    return views.category_by_model(A.responses(spark, sf), A.questions(spark, sf))


@register("difficulty_by_model", f"""
select difficulty, model_name, {ACC_RAW} as accuracy, count(*) as n,
       case difficulty when 'easy' then 1 when 'medium' then 2 when 'hard' then 3 else 4 end as difficulty_rank
from (select * replace (case when difficulty in ('PROMO', 'ECONOMY') then 'easy' when difficulty = 'STANDARD' then 'medium'
                        when difficulty = 'LARGE' then 'hard' else difficulty end as difficulty) from {E_SQL} e) x
group by difficulty, model_name""")
def q_difficulty_by_model(spark, sf):
    """Four part types stand for the three difficulties; the others lie outside the domain."""
    kind = F.col("difficulty")
    level = (F.when(kind.isin("PROMO", "ECONOMY"), "easy").when(kind == "STANDARD", "medium")
             .when(kind == "LARGE", "hard").otherwise(kind))
    return views.difficulty_by_model(A.responses(spark, sf), A.questions(spark, sf).withColumn("difficulty", level))


@register("category_order", f"""
select category, avg(acc) as mean_accuracy,
       row_number() over (order by avg(acc), category) as category_rank
from (select category, model_name, {ACC_RAW} as acc from {E_SQL} e group by 1, 2) pm group by category""")
def q_category_order(spark, sf):
    return views.category_order(A.responses(spark, sf), A.questions(spark, sf))


_REG_VALUES = ", ".join(f"({sql_lit(v.key)}, {sql_lit(v.label)})" for v in prompts.VARIANTS.values())


@register("prompt_comparison", f"""
select a.*, v.variant_label from (
  select prompt_variant, model_name, {ACC_RAW} as accuracy, count(*) as n, avg(response_time) as latency_mean_s
  from {R} r where model_name in ({_in(COMPARE_MODELS)}) group by prompt_variant, model_name) a
left join (values {_REG_VALUES}) v(prompt_variant, variant_label) using (prompt_variant)""")
def q_prompt_comparison(spark, sf):
    return views.prompt_comparison(A.responses(spark, sf), COMPARE_MODELS)


MP_SQL = f"""(select model_name, count(*) as n_responses,
       cast(sum(case when ai_correct then 1 else 0 end) as bigint) as n_correct,
       {ACC_SQL} as accuracy, round(avg(response_time), 2) as latency_mean_s,
       round(median(response_time), 2) as latency_median_s from {R} r group by model_name)"""


@register("home_kpis", f"""
select (select count(*) from part) as n_questions, count(*) as n_models,
       cast(sum(n_responses) as bigint) as n_responses, max(accuracy) as best_accuracy from {MP_SQL} mp""")
def q_home_kpis(spark, sf):
    return views.home_kpis(A.questions(spark, sf), marts.model_rates(A.responses(spark, sf)))


@register("model_leaderboard", f"""
select *, accuracy * 100.0::double as accuracy_pct,
       row_number() over (order by accuracy desc, model_name) as leaderboard_rank from {MP_SQL} mp""")
def q_model_leaderboard(spark, sf):
    return views.model_leaderboard(marts.model_performance(A.responses(spark, sf)))


UNIVERSE_SQL = f"""(select kind, value, row_number() over (partition by kind order by value) as position from (
  select distinct 'model' as kind, model_name as value from {R} r
  union all select distinct 'prompt_variant' as kind, prompt_variant as value from {R} r2) u)"""


@register("model_universe", f"select * from {UNIVERSE_SQL} x")
def q_model_universe(spark, sf):
    return views.universes(A.responses(spark, sf))


@register("entity_slots", f"""
select kind, value, cast((position - 1) % 8 as integer) as slot,
       [{_in(views.PALETTE)}][cast((position - 1) % 8 as integer) + 1] as color from {UNIVERSE_SQL} x""")
def q_entity_slots(spark, sf):
    return views.entity_slots(A.responses(spark, sf))


@register("run_accuracy", f"""
select count(*) as n_total, count(case when model_name = '{RUN_MODEL}' then 1 end) as n_model,
       avg(case when model_name = '{RUN_MODEL}' then (case when ai_correct then 1.0::double else 0.0::double end) end)
         as accuracy from {R} r""")
def q_run_accuracy(spark, sf):
    return views.run_accuracy(A.responses(spark, sf), RUN_MODEL)


@register("done_counts", f"""
select model_name, count(distinct (question_id, prompt_variant)) as n_done from {R} r group by model_name""")
def q_done_counts(spark, sf):
    return worklist.done_counts(A.responses(spark, sf))


# ------------------------------------------------------------------ sampling (SMP-1)


@register("stratified_sample", f"""
with base as (select p_partkey as question_id, p_brand as category, p_type as difficulty,
                     sha256(concat_ws(':', '{SAMPLE_SEED}', cast(p_partkey as varchar))) as h from part),
sizes as (select category, difficulty, count(*) as len from base group by all),
tot as (select sum(len) as n_all from sizes),
ks as (select s.category, s.difficulty,
              least(len, greatest(1, cast(round_even(len * ({SAMPLE_N} / n_all), 0) as bigint))) as k
       from sizes s, tot),
ranked as (select b.*, k, row_number() over (partition by b.category, b.difficulty order by h, question_id) as rn
           from base b join ks using (category, difficulty)),
strat as (select * from ranked where rn <= k),
capped as (select *, row_number() over (order by h, question_id) as grn from strat)
select question_id, category, difficulty from capped where grn <= {SAMPLE_N}""")
def q_stratified_sample(spark, sf):
    q = A.questions(spark, sf).select("question_id", "category", "difficulty")
    return sampling.stratified_sample(q, SAMPLE_N, SAMPLE_SEED)


# ------------------------------------------------------------------ bronze -> silver (PRJ-4/5, DD-1/2, FN-7, AGG-15)

STRIPPED_SQL = f"""(select {strip_sql('category')} as category, {strip_sql('type')} as type,
    {strip_sql('difficulty')} as difficulty, {strip_sql('question')} as question,
    {strip_sql('correct_answer')} as correct_answer, {strip_sql('incorrect_answers')} as incorrect_answers,
    scraped_at, _ordinal from {B} b)"""
K1_SQL = f"""(select * exclude (rn) from (select *,
    row_number() over (partition by category, type, difficulty, question, correct_answer order by _ordinal) as rn,
    count(*) over (partition by category, type, difficulty, question, correct_answer) as n_raw
  from {STRIPPED_SQL} s) x where rn = 1)"""
K2_SQL = f"""(select * exclude (rn2) from (select *,
    row_number() over (partition by question_id order by _ordinal) as rn2,
    sum(n_raw) over (partition by question_id) as n_raw_id,
    count(*) over (partition by question_id) as n_keys
  from (select *, substr(sha256(category || '::' || question), 1, 16) as question_id from {K1_SQL} k1) i) x
  where rn2 = 1)"""
CHOICES_SQL = f"""list_transform(list_sort(list_transform(list_concat(
    list_filter(list_transform(from_json(incorrect_answers, '["VARCHAR"]'), lambda x: {strip_sql('x')}),
                lambda x: x <> ''), [{strip_sql('correct_answer')}]),
    lambda x: {{'k': sha256(question_id || '::' || x), 'v': x}})), lambda s: s.v)"""
CLEAN_SQL = f"(select *, {CHOICES_SQL} as choices from {K2_SQL} k2)"


def _bronze(spark, sf):
    return A.bronze_questions(spark, sf)


@register("question_id", """
select doc_id, substr(sha256(source || '::' || text), 1, 16) as question_id from documents""")
def q_question_id(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select("doc_id", T.question_id("source", "text").alias("question_id"))


@register("dedupe_exact", f"""
select _ordinal as doc_id, n_raw, substr(sha256(category || '::' || question), 1, 16) as question_id
from {K1_SQL} k1""")
def q_dedupe_exact(spark, sf):
    ex = silver.dedupe_exact(_bronze(spark, sf))
    return ex.select(F.col("_ordinal").alias("doc_id"), F.col("_n_raw").alias("n_raw"),
                     T.question_id("category", "question").alias("question_id"))


@register("dedupe_id", f"""
select _ordinal as doc_id, question_id, n_keys, cast(n_raw_id as bigint) as n_raw from {K2_SQL} k2""")
def q_dedupe_id(spark, sf):
    d = silver.dedupe_id_with_counts(_bronze(spark, sf))
    return d.select(F.col("_ordinal").alias("doc_id"), "question_id",
                    F.col("_n_keys").alias("n_keys"), F.col("_n_raw").alias("n_raw"))


@register("clean_questions", f"""
select question_id, category, type, difficulty, sha256(question) as question_sha256, correct_answer,
       array_to_string(choices, '|') as choices_text, cast(len(choices) as integer) as n_choices, scraped_at
from {CLEAN_SQL} c""")
def q_clean_questions(spark, sf):
    c = silver.clean_questions(_bronze(spark, sf))
    return c.select("question_id", "category", "type", "difficulty",
                    F.sha2("question", 256).alias("question_sha256"), "correct_answer",
                    F.array_join("choices", "|").alias("choices_text"), F.size("choices").alias("n_choices"),
                    "scraped_at")


@register("clean_metrics", f"""
select cast(sum(n_raw_id) as bigint) as rows_read, cast(sum(n_raw_id) - sum(n_keys) as bigint) as exact_duplicates,
       cast(sum(n_keys) - count(*) as bigint) as id_collisions,
       count(case when (type = 'multiple' and len(choices) <> 4) or (type = 'boolean' and len(choices) <> 2)
                  then 1 end) as bad_choice_counts,
       count(*) as rows_written from {CLEAN_SQL} c""")
def q_clean_metrics(spark, sf):
    return silver.clean_metrics(silver.clean_with_counts(_bronze(spark, sf)))


@register("dq_choice_count", f"""
select question_id, type, cast(len(choices) as integer) as n_choices from {CLEAN_SQL} c
where (type = 'multiple' and len(choices) <> 4) or (type = 'boolean' and len(choices) <> 2)""")
def q_dq_choice_count(spark, sf):
    return quality.choice_count(silver.clean_questions(_bronze(spark, sf)))


PART_WRONG = "array(p_brand, p_type, element_at(split(p_name, ' '), 1))"


@register("choices", f"""
select question_id, cast(len(choices) as integer) as n_choices, array_to_string(choices, '|') as choices_text from (
  select cast(p_partkey as varchar) as question_id, list_transform(list_sort(list_transform(list_concat(
      list_filter(list_transform([p_brand, p_type, string_split(p_name, ' ')[1]], lambda x: {strip_sql('x')}),
                  lambda x: x <> ''), [{strip_sql("string_split(p_name, ' ')[-1]")}]),
      lambda x: {{'k': sha256(cast(p_partkey as varchar) || '::' || x), 'v': x}})), lambda s: s.v) as choices
  from part) p""")
def q_choices(spark, sf):
    p = A.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("question_id"),
        F.to_json(F.array("p_brand", "p_type", F.element_at(F.split("p_name", " "), 1))).alias("wrong"),
        F.element_at(F.split("p_name", " "), -1).alias("right"),
    )
    c = p.select("question_id", T.choices("question_id", "wrong", "right").alias("choices"))
    return c.select("question_id", F.size("choices").alias("n_choices"),
                    F.array_join("choices", "|").alias("choices_text"))


@register("json_answers", f"""
select p_partkey, cast(to_json(a) as varchar) as answers_json, cast(len(a) as integer) as n_answers from (
  select p_partkey, list_filter(list_transform(
      [' ' || p_brand || ' ', '', p_type, chr(9) || chr(10), p_name], lambda x: {strip_sql('x')}),
      lambda x: x <> '') as a from part) t""")
def q_json_answers(spark, sf):
    p = A.table(spark, sf, "part").select(
        "p_partkey",
        F.to_json(F.array(F.concat(F.lit(" "), "p_brand", F.lit(" ")), F.lit(""), "p_type",
                          F.lit("\t\n"), "p_name")).alias("raw"),
    )
    a = p.select("p_partkey", T.json_answers("raw").alias("a"))
    return a.select("p_partkey", F.to_json("a").alias("answers_json"), F.size("a").alias("n_answers"))


@register("stg_ai_responses", f"select question_id, model_name, prompt_variant, ai_answer, ai_correct, response_time from {R} r")
def q_stg_ai_responses(spark, sf):
    return marts.stg_ai_responses(A.responses(spark, sf))


# ------------------------------------------------------------------ text functions and grading (FN-4/5/6, SET-3)


@register("normalise_text", f"select conv_id, turn, {norm_sql('text')} as normalised from conversations")
def q_normalise_text(spark, sf):
    c = A.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", T.normalise("text").alias("normalised"))


@register("grade_inclusion", f"""
select conv_id, turn, {grade_sql('na', 'nc')} as ai_correct from (
  select a.conv_id, a.turn, {norm_sql("case when a.conv_id % 2 = 0 then u.text || ' ' || a.text else a.text end")} as na, {norm_sql('u.text')} as nc
  from conversations a join conversations u on u.conv_id = a.conv_id and u.turn = a.turn - 1
  where a.role = 'assistant' and u.role = 'user') p""")
def q_grade_inclusion(spark, sf):
    c = A.table(spark, sf, "conversations")
    answers = c.filter(F.col("role") == "assistant").select("conv_id", "turn", "text")
    asked = c.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("correct_answer"))
    # Every other conversation's replies quote the turn they answer.
    pairs = answers.join(asked, ["conv_id", "turn"], "inner").withColumn("ai_answer", F.when(
        F.col("conv_id") % 2 == 0, F.concat("correct_answer", F.lit(" "), "text")).otherwise(F.col("text")))
    return grading.grade(pairs, "ai_answer", "correct_answer").select("conv_id", "turn", "ai_correct")


@register("grade_boolean", f"""
select conv_id, turn, {grade_sql('na', 'nc')} as ai_correct from (
  select conv_id, turn, {norm_sql('text')} as na,
         {norm_sql("case when role = 'user' then 'True' else 'False' end")} as nc from conversations) p""")
def q_grade_boolean(spark, sf):
    c = A.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("text").alias("ai_answer"),
        F.when(F.col("role") == "user", "True").otherwise("False").alias("correct_answer"))
    return grading.grade(c, "ai_answer", "correct_answer").select("conv_id", "turn", "ai_correct")


_MK = T.REASONING_MARKER
REASONING_SQL = f"""(select doc_id, case lang when 'en' then text
    when 'fr' then text || '{_MK}' || lower(hex(doc_id)) || '__'
    when 'es' then 'Thinking about ' || source || '{_MK}' || lower(hex(doc_id)) || '__' || chr(10) || text
    else text || '{_MK}ab__ middle ' || '{_MK}' || lower(hex(doc_id + 7)) || '__' || chr(10) || ' tail answer '
    end as content from documents)"""


def _reasoning_content(spark, sf):
    d = A.table(spark, sf, "documents")
    hx = F.lower(F.hex("doc_id"))
    mk = lambda h: F.concat(F.lit(_MK), h, F.lit("__"))
    content = (
        F.when(F.col("lang") == "en", F.col("text"))
        .when(F.col("lang") == "fr", F.concat("text", mk(hx)))
        .when(F.col("lang") == "es", F.concat(F.lit("Thinking about "), "source", mk(hx), F.lit("\n"), "text"))
        .otherwise(F.concat("text", mk(F.lit("ab")), F.lit(" middle "), mk(F.lower(F.hex(F.col("doc_id") + 7))),
                            F.lit("\n tail answer ")))
    )
    return d.select("doc_id", content.alias("content"))


@register("strip_reasoning", f"""
select doc_id, sha256(s) as answer_sha256, cast(length(s) as integer) as answer_chars from (
  select doc_id, {strip_sql(f"regexp_replace(content, '(?s)^.*{_MK}[0-9a-f]+__', '')")} as s
  from {REASONING_SQL} r) x""")
def q_strip_reasoning(spark, sf):
    s = _reasoning_content(spark, sf).select("doc_id", T.strip_reasoning("content").alias("s"))
    return s.select("doc_id", F.sha2("s", 256).alias("answer_sha256"), F.length("s").alias("answer_chars"))


# ------------------------------------------------------------------ prompts, work list, inference, merge

VARIANT_KEYS = list(prompts.VARIANTS)
OUTPUT_SQL = """chr(10) || chr(10) || 'Output: one short phrase on a single line.'
       || (case when type = 'boolean' then chr(10) || 'Choices: True, False' else '' end)"""
PROMPT_SQL = f"""(case prompt_variant when 'naive' then question
  when 'strict_format' then question || {OUTPUT_SQL}
  when 'role_expert' then 'Persona: quiz champion who states facts and adds nothing.' || chr(10) || 'Topic: ' || category
       || ' / level: ' || difficulty || chr(10) || chr(10) || question || {OUTPUT_SQL} end)"""
WORK_ALL_SQL = f"""(select _ordinal as question_id, category, difficulty, type, question, correct_answer,
    unnest([{_in(VARIANT_KEYS)}]) as prompt_variant, '{A.DONE_MODEL}' as model_name from {B} b)"""
WORK_PENDING_SQL = f"""(select * from {WORK_ALL_SQL} w where not exists (select 1 from {A.DONE_SQL} d
    where d.question_id = w.question_id and d.prompt_variant = w.prompt_variant and d.model_name = w.model_name))"""


def _questions_b(spark, sf):
    return A.bronze_questions(spark, sf).withColumnRenamed("_ordinal", "question_id")


def _work(spark, sf, pending: bool):
    done = A.done_responses(spark, sf) if pending else None
    return worklist.pending_worklist(_questions_b(spark, sf), VARIANT_KEYS, A.DONE_MODEL, done,
                                     keep=worklist.TEMPLATE_FIELDS + ["correct_answer"])


@register("build_prompts", f"""
select question_id, prompt_variant, sha256(p) as prompt_sha256, cast(length(p) as integer) as prompt_chars from (
  select question_id, prompt_variant, {PROMPT_SQL} as p from {WORK_ALL_SQL} w) x""")
def q_build_prompts(spark, sf):
    w = worklist.with_prompts(_work(spark, sf, pending=False))
    return w.select("question_id", "prompt_variant", F.sha2("prompt", 256).alias("prompt_sha256"),
                    F.length("prompt").alias("prompt_chars"))


@register("pending_worklist", f"select question_id, prompt_variant, model_name from {WORK_PENDING_SQL} w")
def q_pending_worklist(spark, sf):
    return _work(spark, sf, pending=True).select("question_id", "prompt_variant", "model_name")


# The offline EchoClient replies with the whole prompt.
ECHO_SQL = PROMPT_SQL


def _answers_sql(work_sql: str) -> str:
    ans = strip_sql(f"regexp_replace({ECHO_SQL}, '(?s)^.*{_MK}[0-9a-f]+__', '')")
    return f"""(select question_id, model_name, prompt_variant, ai_answer,
      {grade_sql(norm_sql('ai_answer'), norm_sql('correct_answer'))} as ai_correct from (
      select question_id, model_name, prompt_variant, correct_answer, {ans} as ai_answer from (
        select * from {work_sql} w) x) y)"""


def _answers(spark, sf, pending: bool):
    work = worklist.with_prompts(_work(spark, sf, pending))
    raw = inference.infer(work, inference.EchoClient)
    return inference.answers(raw, _questions_b(spark, sf))


@register("batch_inference", f"select * from {_answers_sql(WORK_PENDING_SQL)} a")
def q_batch_inference(spark, sf):
    return _answers(spark, sf, pending=True).drop("response_time")


MAX_PROMPT = 2000


@register("inference_dead_letters", f"""
select question_id, model_name, prompt_variant, 'ValueError: ' || cast(length(p) as varchar) || ' characters' as error
from (select *, {PROMPT_SQL} as p from {WORK_ALL_SQL} w) x where length(p) > {MAX_PROMPT}""")
def q_inference_dead_letters(spark, sf):
    """A model that refuses long prompts: the refused calls, each with its error."""
    limit = MAX_PROMPT

    class ShortPrompts:  # defined here so that it is shipped to the workers by value
        def ask(self, prompt):
            if len(prompt) > limit:
                raise ValueError(f"{len(prompt)} characters")
            return prompt

    raw = inference.infer(worklist.with_prompts(_work(spark, sf, pending=False)), ShortPrompts)
    return inference.dead_letters(raw).select("question_id", "model_name", "prompt_variant", "error")


@register("response_merge", f"""
select question_id, model_name, prompt_variant, ai_answer, ai_correct from {A.DONE_SQL} d
union all
select * from {_answers_sql(WORK_ALL_SQL)} n where not exists (select 1 from {A.DONE_SQL} d
  where d.question_id = n.question_id and d.prompt_variant = n.prompt_variant and d.model_name = n.model_name)""")
def q_response_merge(spark, sf):
    from benchlake.session import materialize

    # Model replies are expensive: materialised once (reliable checkpoint), then merged.
    merged = merge.merge_responses(A.done_responses(spark, sf), materialize(_answers(spark, sf, pending=False)))
    return merged.drop("response_time")


# ------------------------------------------------------------------ bronze decode / flatten / coverage


def _b64_sql(x: str) -> str:
    return f"to_base64(encode({x}))"


@register("api_decode", """
select doc_id, source as category, case when n_chars < 1000 then 'boolean' else 'multiple' end as type,
       lang as difficulty, sha256(text) as question_sha256, [source, lang, sha256(text), ' '][1] as correct_answer,
       array_to_string([source, lang, sha256(text), ' '][2:4], '|') as incorrect_text
from documents where lang <> 'de'""")
def q_api_decode(spark, sf):
    d = A.table(spark, sf, "documents")
    words = A.answer_words()
    question = F.struct(
        T.b64encode("source").alias("category"),
        T.b64encode(F.when(F.col("n_chars") < 1000, "boolean").otherwise("multiple")).alias("type"),
        T.b64encode("lang").alias("difficulty"),
        T.b64encode("text").alias("question"),
        T.b64encode(F.element_at(words, 1)).alias("correct_answer"),
        F.transform(F.slice(words, 2, 3), T.b64encode).alias("incorrect_answers"),
    )
    no_results = F.col("lang") == "de"
    payload = F.to_json(F.struct(
        F.when(no_results, F.lit(bronze_src.RC_NO_RESULTS)).otherwise(F.lit(bronze_src.RC_SUCCESS)).alias("response_code"),
        F.when(no_results, F.array().cast("array<struct<category:string,type:string,difficulty:string,"
                                          "question:string,correct_answer:string,incorrect_answers:array<string>>>"))
         .otherwise(F.array(question)).alias("results"),
    ))
    rows = bronze_src.decode_payloads(d.select("doc_id", payload.alias("payload")), carry=["doc_id"])
    return rows.select("doc_id", "category", "type", "difficulty", F.sha2("question", 256).alias("question_sha256"),
                       "correct_answer", F.array_join("incorrect_answers", "|").alias("incorrect_text"))


SCRAPED_AT = "2024-01-01T00:00:00+00:00"


@register("raw_batch_flatten", f"""
select category, type, difficulty, sha256(text) as question_sha256, sha256(text) as correct_answer,
       cast(to_json(['item ' || cast(item_id as varchar), text]) as varchar) as incorrect_answers, '{SCRAPED_AT}' as scraped_at,
       item_id as _batch, 0 as _pos
from (select item_id, text, 'General Knowledge' as category, 'multiple' as type, 'easy' as difficulty from benchmark) b""")
def q_raw_batch_flatten(spark, sf):
    bm = A.table(spark, sf, "benchmark")
    wrong = F.array(F.concat(F.lit("item "), F.col("item_id").cast("string")), F.col("text"))
    q = F.struct(F.lit("General Knowledge").alias("category"), F.lit("multiple").alias("type"),
                 F.lit("easy").alias("difficulty"), F.col("text").alias("question"),
                 F.sha2("text", 256).alias("correct_answer"), wrong.alias("incorrect_answers"))
    doc = F.to_json(F.struct(F.lit(9).alias("category"), F.lit("easy").alias("difficulty"),
                             F.lit("multiple").alias("type"), F.array(q).alias("questions")))
    from benchlake.schemas import RAW_BATCH
    batches = bm.select("item_id", F.from_json(doc, RAW_BATCH).alias("b")).select("item_id", "b.*")
    flat = bronze_src.flatten_batches(batches, SCRAPED_AT, batch_col="item_id")
    return flat.select("category", "type", "difficulty", F.sha2("question", 256).alias("question_sha256"),
                       "correct_answer", "incorrect_answers", "scraped_at", "_batch", "_pos")


@register("coverage_grid", f"""
with b as {B},
g as (select category, difficulty, unnest(['multiple', 'boolean']) as type from (
        select category, unnest([{_in(LANGS)}]) as difficulty from (select distinct category from b) c) d),
n as (select category, difficulty, type, count(*) as n from b group by all)
select g.category, g.difficulty, g.type, coalesce(n.n, 0) as n_questions
from g left join n on g.category = n.category and g.difficulty = n.difficulty and g.type = n.type""")
def q_coverage_grid(spark, sf):
    return coverage.coverage_grid(A.bronze_questions(spark, sf), LANGS, ["multiple", "boolean"])


# ------------------------------------------------------------------ data quality (QA-1..6)


@register("dq_unique", """
select question_id, count(*) as n_rows from (
  select substr(sha256(source || '::' || text), 1, 16) as question_id from documents) x
where question_id is not null group by question_id having count(*) > 1""")
def q_dq_unique(spark, sf):
    d = A.table(spark, sf, "documents").select(T.question_id("source", "text").alias("question_id"))
    return quality.unique(d, "question_id")


@register("dq_orphans", f"""
select d.doc_id as question_id, count(*) as n_responses from documents d
where not exists (select 1 from labels l where l.doc_id = d.doc_id) group by d.doc_id""")
def q_dq_orphans(spark, sf):
    """Documents as responses, labels as their questions: the unlabelled ones are orphans."""
    responses = A.table(spark, sf, "documents").select(F.col("doc_id").alias("question_id"))
    return quality.orphans(responses, A.table(spark, sf, "labels").select(F.col("doc_id").alias("question_id")))


def _nn(table_sql: str, name: str, cols: list[str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, '{c}' as column_name, count(*) - count({c}) as n_nulls from {table_sql} t"
        for c in cols)


@register("dq_not_null", " union all ".join([
    _nn(f"(select question_id, category, type as question_type, difficulty from {Q} q)", "stg_questions",
        quality.NOT_NULL["stg_questions"]),
    _nn("""(select d.doc_id as question_id, case l.quality when 1 then 'good' when 0 then 'junk' end as model_name,
                   case l.toxic when 1 then 'toxic' when 0 then 'clean' end as prompt_variant
            from documents d left join labels l on l.doc_id = d.doc_id)""",
        "stg_ai_responses", quality.NOT_NULL["stg_ai_responses"]),
    _nn(E_SQL, "stg_responses_enriched", quality.NOT_NULL["stg_responses_enriched"]),
]))
def q_dq_not_null(spark, sf):
    """Documents as responses: the unlabelled ones have neither model nor variant.  The enriched
    table is checked as written."""
    stq = marts.stg_questions(A.questions(spark, sf))
    docs, lab = A.table(spark, sf, "documents").select("doc_id"), A.table(spark, sf, "labels")
    joined = docs.join(lab.select(F.col("doc_id").alias("_of"), "quality", "toxic"), F.col("doc_id") == F.col("_of"), "left")
    resp = joined.select(F.col("doc_id").alias("question_id"),
                         F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "junk").alias("model_name"),
                         F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean").alias("prompt_variant"))
    path = _scratch(spark, "not-null")
    files.write_tables({"stg_responses_enriched": marts.responses_enriched(A.responses(spark, sf), stq)}, path)
    return quality.not_null({"stg_questions": stq, "stg_ai_responses": resp,
                             "stg_responses_enriched": spark.read.parquet(f"{path}/stg_responses_enriched")})


@register("dq_accepted_values", f"""
select 'question_type' as column_name, question_type as value, count(*) as n_rows
from (select type as question_type from {Q} q) x
where question_type is not null and question_type not in ('multiple', 'boolean') group by question_type
union all
select 'difficulty' as column_name, difficulty as value, count(*) as n_rows from {Q} q
where difficulty is not null and difficulty not in ('easy', 'medium', 'hard') group by difficulty""")
def q_dq_accepted_values(spark, sf):
    return quality.accepted_values(marts.stg_questions(A.questions(spark, sf)))


@register("dq_response_keys", f"""
select question_id, prompt_variant, model_name, count(*) as n_rows from {R} r
group by question_id, prompt_variant, model_name having count(*) > 1""")
def q_dq_response_keys(spark, sf):
    return quality.response_keys(A.responses(spark, sf))


# ------------------------------------------------------------------ streaming merge (ST-1)


@register("response_merge_stream", f"""
select cast(question_id as varchar) as question_id, model_name, prompt_variant, ai_answer, ai_correct
from {A.DONE_SQL} d
union all
select cast(question_id as varchar), model_name, prompt_variant, ai_answer, ai_correct
from {_answers_sql(WORK_ALL_SQL)} n where not exists (select 1 from {A.DONE_SQL} d
  where d.question_id = n.question_id and d.prompt_variant = n.prompt_variant and d.model_name = n.model_name)""")
def q_response_merge_stream(spark, sf):
    """Two response-log increments merged by the availableNow stream (first answer wins).

    The log, the target table and the stream's checkpoint live in a fresh folder under the
    session's reliable checkpoint directory.
    """
    import uuid

    from benchlake.session import ensure_checkpoint_dir

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/response-merge-{uuid.uuid4().hex}"
    log, target = f"{root}/log", f"{root}/responses"
    as_log = lambda df: df.select(F.col("question_id").cast("string").alias("question_id"),
                                  *[c for c in ["model_name", "prompt_variant", "ai_answer", "ai_correct",
                                                "response_time"]])
    files.append_response_log(as_log(A.done_responses(spark, sf)), log, "gzip")
    files.append_response_log(as_log(_answers(spark, sf, pending=False)), log, "gzip")
    merge.stream_merge(spark, log, target)  # one micro-batch: the earlier increment's answers win
    return merge.read_target(spark, target).drop("response_time")


# ------------------------------------------------------------------ file round trips, sinks and small operators
# (SRC-2/3/5/6/8, SNK-1/2/4/5/6/7, SMP-2, FN-14, regrade).  Files are written to a fresh folder under
# the session's reliable checkpoint directory and read back.

from benchlake.functions.text import b64encode  # noqa: E402
from benchlake.schemas import QUESTIONS_RAW_COLUMNS  # noqa: E402


def _scratch(spark, name: str) -> str:
    import uuid

    from benchlake.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _coalesced(cols: list[str]) -> str:
    return ", ".join(f"coalesce({c}, '') as {c}" for c in cols)


@register("csv_roundtrip", f"""
select category, type, difficulty, sha256(question) as question_sha256, correct_answer,
       sha256(incorrect_answers) as incorrect_sha256, scraped_at
from (select {_coalesced(QUESTIONS_RAW_COLUMNS)} from {B} b) x""")
def q_csv_roundtrip(spark, sf):
    """Bronze rows (long multi-line texts) -> quoted CSV -> all-string read with blanks kept."""
    path = _scratch(spark, "bronze-csv")
    files.write_bronze_csv(A.bronze_questions(spark, sf).select(*QUESTIONS_RAW_COLUMNS), path)
    back = files.read_bronze_csv(spark, path)
    return back.select("category", "type", "difficulty", F.sha2("question", 256).alias("question_sha256"),
                       "correct_answer", F.sha2("incorrect_answers", 256).alias("incorrect_sha256"), "scraped_at")


def _question_struct(words) -> F.Column:
    return F.struct(
        b64encode("source").alias("category"),
        b64encode(F.when(F.col("n_chars") < 1000, "boolean").otherwise("multiple")).alias("type"),
        b64encode("lang").alias("difficulty"),
        b64encode("text").alias("question"),
        b64encode(F.element_at(words, 1)).alias("correct_answer"),
        F.transform(F.slice(words, 2, 3), b64encode).alias("incorrect_answers"),
    )


def _doc_payloads(spark, sf) -> DataFrame:
    """One captured API payload per document: ``en`` a success, ``de`` 'no results' or a field that is
    no UTF-8, ``fr`` a success without questions or with a field that is no base64, ``es`` a malformed
    or cut-off body; the second of each for texts under 1000 characters."""
    d = A.table(spark, sf, "documents")
    words = A.answer_words()
    lang = F.col("lang")
    short = F.col("n_chars") < 1000
    code = F.when((lang == "de") & ~short, F.lit(bronze_src.RC_NO_RESULTS)).otherwise(F.lit(bronze_src.RC_SUCCESS))
    broken = F.when(lang == "de", "//79").when(lang == "fr", "@@@")  # the bytes FF FE FD; no base64
    question = _question_struct(words)
    question = question.withField("correct_answer", F.when(short, broken.cast("string")).otherwise(question["correct_answer"]))
    question = F.when(short & lang.isin("de", "fr"), question).otherwise(_question_struct(words))
    results = F.when(lang.isin("de", "fr") & ~short, F.array().cast(
        "array<struct<category:string,type:string,difficulty:string,question:string,correct_answer:string,"
        "incorrect_answers:array<string>>>")).otherwise(F.array(question))
    body = F.to_json(F.struct(code.alias("response_code"), results.alias("results")))
    # A malformed body has a stray comma after its opening brace; a cut-off one lacks its end.
    payload = (F.when((lang == "es") & short, F.regexp_replace(body, r"\]\}$", ""))
               .when(lang == "es", F.regexp_replace(body, r"^\{", "{,")).otherwise(body))
    return d.select("doc_id", payload.alias("payload"))


@register("payload_dead_letters", """
select doc_id, case when lang = 'es' then 'malformed' when n_chars < 1000 then 'undecodable'
                    when lang = 'de' then 'response_code=1' else 'empty' end as reason
from documents where lang in ('de', 'es', 'fr')""")
def q_payload_dead_letters(spark, sf):
    return bronze_src.failed_payloads(_doc_payloads(spark, sf)).select("doc_id", "reason")


@register("raw_batch_archive", f"""
select doc_id as batch_category, source as category,
       case when n_chars < 1000 then 'boolean' else 'multiple' end as type, lang as difficulty,
       sha256(text) as question_sha256, [source, lang, sha256(text), ' '][1] as correct_answer,
       array_to_string([source, lang, sha256(text), ' '][2:4], '|') as incorrect_text, '{SCRAPED_AT}' as scraped_at, 0 as _pos
from documents where lang = 'en'""")
def q_raw_batch_archive(spark, sf):
    """Payloads -> decoded raw batches archived as JSON files -> scanned back and flattened."""
    batches = bronze_src.decode_batches(_doc_payloads(spark, sf), carry=["doc_id"], category_id="doc_id")
    path = _scratch(spark, "raw-batches")
    bronze_src.write_raw_batches(batches.drop("doc_id"), path)
    back = bronze_src.read_raw_batches_lines(spark, path)
    flat = bronze_src.flatten_batches(back, SCRAPED_AT, batch_col="category")
    return flat.select(F.col("_batch").cast("long").alias("batch_category"), "category", "type", "difficulty",
                       F.sha2("question", 256).alias("question_sha256"), "correct_answer",
                       F.array_join(F.from_json("incorrect_answers", "array<string>"), "|").alias("incorrect_text"),
                       "scraped_at", "_pos")


DELIVERY_SQL = """(select source, lang, text, n_chars, doc_id, d,
    case when d = 2 then lang else source end as answer,
    case when n_chars < 1000 then 'boolean' else 'multiple' end as type,
    -(doc_id * 3 + (d + n_chars) % 3) as batch
  from (select *, unnest([0, 1, 2]) as d from documents) x)"""


@register("bronze_load", f"""
with t as (select {strip_sql('source')} as category, {strip_sql('text')} as question, {strip_sql('answer')} as answer,
                  type, lang, doc_id, d, batch from {DELIVERY_SQL} p),
ids as (select *, substr(sha256(category || '::' || question), 1, 16) as question_id from t),
ranked as (select *, row_number() over (partition by question_id order by batch) as rn,
                  count(*) over (partition by question_id) as n_raw from ids),
kinds as (select question_id, count(*) as n_keys from (select distinct question_id, type, lang, answer from ids) k group by 1)
select question_id, category, type, lang as difficulty, answer as correct_answer,
       array_to_string(list_sort(['wrong ' || cast(doc_id as varchar) || ' ' || cast(d as varchar), answer]), '|') as choices_text,
       n_raw, n_keys, '{SCRAPED_AT}' as scraped_at
from ranked join kinds using (question_id) where rn = 1""")
def q_bronze_load(spark, sf):
    """Payloads -> archive -> CSV -> silver.  Every document comes three times: twice with the same
    content and other wrong answers, once with another right answer; the batch numbers, which
    run against the order of the rows, say which came first."""
    d = A.table(spark, sf, "documents").select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("d"))
    answer = F.when(F.col("d") == 2, F.col("lang")).otherwise(F.col("source"))
    question = _question_struct(F.array(answer, F.concat_ws(" ", F.lit("wrong"), "doc_id", "d")))
    body = F.to_json(F.struct(F.lit(bronze_src.RC_SUCCESS).alias("response_code"), F.array(question).alias("results")))
    payloads = d.select((-(F.col("doc_id") * 3 + (F.col("d") + F.col("n_chars")) % 3)).alias("batch"), body.alias("payload"))
    root = _scratch(spark, "bronze-load")
    flows.bronze_from_payloads(payloads, f"{root}/raw", f"{root}/csv", SCRAPED_AT, batch_col="batch")
    clean = silver.clean_with_counts(files.read_bronze_csv(spark, f"{root}/csv", ordinal=True))
    return clean.select("question_id", "category", "type", "difficulty", "correct_answer",
                        F.array_join(F.array_sort("choices"), "|").alias("choices_text"),
                        F.col("_n_raw").alias("n_raw"), F.col("_n_keys").alias("n_keys"), "scraped_at")


SECOND_MODEL = "model-b"
LOG_SQL = f"""(select cast(question_id as varchar) as question_id, model_name, prompt_variant, ai_answer, ai_correct,
    response_time from {A.DONE_SQL} d
  union all
  select cast(doc_id as varchar), '{SECOND_MODEL}', case when toxic = 1 then 'role_expert' else 'naive' end,
    'quality ' || cast(quality as varchar) || ', toxic ' || cast(toxic as varchar), (quality = 1),
    cast(quality + toxic as double) from labels)"""


def _log_increments(spark, sf) -> list[DataFrame]:
    done = A.done_responses(spark, sf).withColumn("question_id", F.col("question_id").cast("string"))
    lab = A.table(spark, sf, "labels")
    second = lab.select(
        F.col("doc_id").cast("string").alias("question_id"), F.lit(SECOND_MODEL).alias("model_name"),
        F.when(F.col("toxic") == 1, "role_expert").otherwise("naive").alias("prompt_variant"),
        F.concat(F.lit("quality "), F.col("quality").cast("string"), F.lit(", toxic "),
                 F.col("toxic").cast("string")).alias("ai_answer"),
        (F.col("quality") == 1).alias("ai_correct"),
        (F.col("quality") + F.col("toxic")).cast("double").alias("response_time"))
    return [done, second]


@register("response_log_compact", f"select * from {LOG_SQL} l")
def q_response_log_compact(spark, sf):
    """Absent log reads empty; two appended increments; the table is rewritten to a new path."""
    root = _scratch(spark, "response-log")
    log = f"{root}/log"
    before = files.read_response_log(spark, log)
    if before.count():
        raise RuntimeError("a fresh log must read as empty")
    for inc in _log_increments(spark, sf):
        files.append_response_log(inc, log)
    return files.compact_log(spark, log, f"{root}/responses")


PREFIX_CATEGORIES = 5


@register("category_prefix", f"""
select question_id, category, difficulty from {Q} q
where category in (select distinct category from {Q} q2 order by category limit {PREFIX_CATEGORIES})""")
def q_category_prefix(spark, sf):
    """Quick-run mode: only the questions of the first N categories (the limit is the feature)."""
    q = A.questions(spark, sf)
    first = coverage.first_categories(q.select(F.col("category").alias("_cat")).distinct(), PREFIX_CATEGORIES,
                                      "_cat")
    # At most PREFIX_CATEGORIES rows by construction: a broadcast of a proven size.
    return q.join(F.broadcast(first), q["category"] == first["_cat"], "left_semi").select(
        "question_id", "category", "difficulty")


@register("display_kpis", f"""
select replace(format('{{:,}}', n_questions), ',', ' ') as questions, cast(n_models as varchar) as models,
       cast(n_responses as varchar) as responses, format('{{:.1f}}%', best_accuracy * 100.0::double) as best_accuracy
from (select (select count(*) from part) as n_questions, count(*) as n_models,
             cast(sum(n_responses) as bigint) as n_responses, max(accuracy) as best_accuracy from {MP_SQL} mp) k""")
def q_display_kpis(spark, sf):
    return views.display_kpis(views.home_kpis(A.questions(spark, sf), marts.model_rates(A.responses(spark, sf))))


@register("regrade", f"""
select a.question_id, {grade_sql(norm_sql('a.ai_answer'), norm_sql('q.correct_answer'))} as ai_correct
from (select cast(conv_id as varchar) || ':' || cast(turn as varchar) as question_id, text as ai_answer
      from conversations where role = 'assistant') a
join (select cast(conv_id as varchar) || ':' || cast(turn + 1 as varchar) as question_id,
             text as correct_answer from conversations where role = 'user') q
using (question_id)""")
def q_regrade(spark, sf):
    """Stored answers with a stale grade are re-graded against their question's answer."""
    c = A.table(spark, sf, "conversations")
    stored = c.filter(F.col("role") == "assistant").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("question_id"),
        F.lit(DONE_MODEL).alias("model_name"), F.lit("naive").alias("prompt_variant"),
        F.col("text").alias("ai_answer"), F.lit(None).cast("boolean").alias("ai_correct"),
        F.lit(None).cast("double").alias("response_time"))
    qs = c.filter(F.col("role") == "user").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") + 1).cast("string")).alias("question_id"),
        F.col("text").alias("correct_answer"))
    return grading.regrade(stored, qs).select("question_id", "ai_correct")


GOLD_MODEL, GOLD_MIN_RESPONSES = "O", 10


@register("gold_tables", f"""
select category, model_name, prompt_variant, n_responses, accuracy from (
  select q.category, r.model_name, r.prompt_variant, count(*) as n_responses, {ACC_SQL} as accuracy
  from {R} r inner join {Q} q using (question_id) group by 1, 2, 3) c
where model_name = '{GOLD_MODEL}' and n_responses >= {GOLD_MIN_RESPONSES}""")
def q_gold_tables(spark, sf):
    """Every staging model and mart materialised as a table, registered by name and read back
    with a parameterised SQL query (positional markers), like a dashboard page."""
    root = _scratch(spark, "gold")
    paths = files.write_tables(marts.build_gold(A.responses(spark, sf), A.questions(spark, sf)), root)
    cat = files.Catalog(spark, root, template="{root}/{name}")
    for name in paths:
        cat.register(name, cat.source(name))
    return cat.sql("select category, model_name, prompt_variant, n_responses, accuracy from fct_category_accuracy "
                   "where model_name = ? and n_responses >= ?", args=[GOLD_MODEL, GOLD_MIN_RESPONSES])


GOLD_MARTS = {  # table: (query of the same mart, its keys)
    "fct_model_performance": ("model_performance", ("model_name",)),
    "fct_prompt_performance": ("prompt_performance", ("model_name", "prompt_variant")),
    "fct_category_accuracy": ("category_accuracy", ("category", "model_name", "prompt_variant")),
    "fct_difficulty_accuracy": ("difficulty_accuracy", ("difficulty", "model_name", "prompt_variant")),
    "fct_response_time": ("response_time", ("model_name", "prompt_variant")),
}
MART_KEYS = ("category", "difficulty", "model_name", "prompt_variant")
MART_VALUES = ("n_responses", "n_correct", "accuracy", "latency_min_s", "latency_mean_s", "latency_median_s", "latency_max_s")


def _mart_sql(table: str, query: str, own: tuple[str, ...]) -> str:
    sql = ORACLE_SQL[query]
    keys = ", ".join(f"{k if k in own else 'cast(null as varchar)'} as {k}" for k in MART_KEYS)
    values = ", ".join(f"cast({v if f'as {v}' in sql else 'null'} as double) as {v}" for v in MART_VALUES)
    return f"select '{table}' as table_name, {keys}, {values} from ({sql}) m"


@register("gold_marts", " union all ".join(_mart_sql(t, q, own) for t, (q, own) in GOLD_MARTS.items()))
def q_gold_marts(spark, sf):
    """The five marts as ``build_gold`` writes them, read back and laid under one another."""
    paths = files.write_tables(marts.build_gold(A.responses(spark, sf), A.questions(spark, sf)), _scratch(spark, "gold"))
    out = None
    for name in GOLD_MARTS:
        t = spark.read.parquet(paths[name])
        row = t.select(F.lit(name).alias("table_name"),
                       *[(F.col(k) if k in t.columns else F.lit(None)).cast("string").alias(k) for k in MART_KEYS],
                       *[(F.col(v) if v in t.columns else F.lit(None)).cast("double").alias(v) for v in MART_VALUES])
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ durable runs, progress, versions, gates

from benchlake.operators import durable, gates, joins, progress  # noqa: E402
from benchlake.sources import history, versions  # noqa: E402

EVERY = 10


@register("call_progress", f"""
select model_name, n_calls, round(mean, 6) as mean_seconds from (
  select l_linestatus as model_name, row_number() over w as n_calls, count(*) over (partition by l_linestatus) as total,
         avg(l_quantity) over (w rows between unbounded preceding and current row) as mean
  from lineitem window w as (partition by l_linestatus order by l_orderkey, l_linenumber, l_quantity)) x
where n_calls % {EVERY} = 0 or n_calls = total""")
def q_call_progress(spark, sf):
    """Mean seconds a call after every tenth call of a model, and after its last."""
    calls = A.table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("model_name"), "l_orderkey", "l_linenumber", "l_quantity")
    out = progress.running_mean(calls, ["model_name"], ["l_orderkey", "l_linenumber"], "l_quantity", EVERY)
    return out.select("model_name", F.col("n").alias("n_calls"), F.round("mean", 6).alias("mean_seconds"))


DURABLE_SLICES = 4
DIGEST_ANSWERS_SQL = f"""(select question_id, model_name, prompt_variant, ai_answer,
    {grade_sql(norm_sql('ai_answer'), norm_sql('correct_answer'))} as ai_correct from (
    select question_id, model_name, prompt_variant, correct_answer, sha256({PROMPT_SQL}) as ai_answer from {WORK_PENDING_SQL} w) x)"""


@register("durable_enrichment", f"""
select cast(question_id as varchar) as question_id, model_name, prompt_variant, ai_answer, ai_correct from {A.DONE_SQL} d
union all
select cast(question_id as varchar), model_name, prompt_variant, ai_answer, ai_correct from {DIGEST_ANSWERS_SQL} a""")
def q_durable_enrichment(spark, sf):
    """A run whose model dies part-way, and a second one that calls it for the rest only: the log
    then holds every answer once.  The model's answer is the digest of its whole prompt."""
    import hashlib

    root = _scratch(spark, "durable")
    log, store = f"{root}/log", f"{root}/replies"
    questions = _questions_b(spark, sf).withColumn("question_id", F.col("question_id").cast("string"))
    files.append_response_log(A.done_responses(spark, sf).withColumn("question_id", F.col("question_id").cast("string")), log)
    pending = 3 * questions.count()
    fatal = worklist.with_prompts(questions.withColumn("prompt_variant", F.lit("role_expert"))).agg(
        F.max(F.sha2("prompt", 256))).first()[0]  # the call that the first model doesn't survive

    class ModelGone(BaseException):  # not an error of one call: it ends the task
        pass

    class Digest:
        def ask(self, prompt):
            return hashlib.sha256(prompt.encode()).hexdigest()

    class Mortal(Digest):
        def ask(self, prompt):
            answer = super().ask(prompt)
            if answer == fatal:
                raise ModelGone
            return answer

    run = {"slice_calls": max(1, -(-pending // DURABLE_SLICES)), "concurrency": spark.sparkContext.defaultParallelism}
    try:
        durable.run_slices(questions, VARIANT_KEYS, A.DONE_MODEL, Mortal, store, log, **run)
    except Exception as gone:  # noqa: BLE001 - the job's error, whatever wraps it
        if "ModelGone" not in str(gone):
            raise
    durable.run_slices(questions, VARIANT_KEYS, A.DONE_MODEL, Digest, store, log, **run)
    return files.read_response_log(spark, log).drop("response_time")


@register("published_responses", f"select * from {LOG_SQL} l")
def q_published_responses(spark, sf):
    """The responses table rewritten from a growing log, three times, each swapped in as a version;
    read through the pointer.  A version that was staged only is never seen."""
    root = _scratch(spark, "published")
    log, store = f"{root}/log", f"{root}/responses"
    for increment in _log_increments(spark, sf):
        files.append_response_log(increment, log)
        flows.publish_responses(spark, log, store)
    versions.stage(spark, {"ai_responses": files.read_response_log(spark, log).limit(0)}, store)  # a crash before the swap
    return versions.load(spark, store).read(spark, "ai_responses")


HOT_SQL = f"""(select case when r.prompt_variant = 'naive' then (select min(p_partkey) from part) else r.question_id end as question_id,
    r.model_name, r.prompt_variant, r.ai_answer, r.ai_correct, r.response_time from {R} r)"""


@register("hot_question_join", f"""
select r.*, q.category, q.type as question_type, q.difficulty from {HOT_SQL} r join {Q} q on q.question_id = r.question_id""")
def q_hot_question_join(spark, sf):
    """Responses with their question when one question holds all answers of a variant: the hot
    question's rows aren't shuffled."""
    q = marts.stg_questions(A.questions(spark, sf)).select("question_id", "category", "question_type", "difficulty")
    least = q.agg(F.min("question_id")).scalar()
    r = A.responses(spark, sf).withColumn("question_id", F.when(F.col("prompt_variant") == "naive", least).otherwise(F.col("question_id")))
    return joins.skew_join(marts.stg_ai_responses(r), q, "question_id")


HISTORY_INCREMENTS = 3


@register("indexed_history", f"""
select question_id, model_name, prompt_variant, ai_answer, ai_correct, response_time from (
  select l_partkey as question_id, l_linestatus as model_name, {A.VARIANT_SQL} as prompt_variant,
         cast(l_linenumber as varchar) as ai_answer, (l_discount <= 0.03) as ai_correct, l_quantity as response_time,
         row_number() over (partition by l_partkey, l_linestatus, l_returnflag
                            order by l_orderkey % {HISTORY_INCREMENTS}, l_orderkey, l_linenumber) as nth from lineitem) x
where nth = 1""")
def q_indexed_history(spark, sf):
    """All responses, merged as increments into a history whose index says which files may hold a
    key; the first answer of a key stays.  The last increment comes twice, as after a retry."""
    rows = A.responses(spark, sf, "l_orderkey", "l_linenumber").withColumn("arrival", F.struct("l_orderkey", "l_linenumber"))
    keep = A.responses(spark, sf)
    store = history.History(spark, _scratch(spark, "history"), keep.schema, merge.RESPONSE_KEY, buckets=8)
    for i in [*range(HISTORY_INCREMENTS), HISTORY_INCREMENTS - 1]:
        store.append(rows.where(F.pmod("l_orderkey", F.lit(HISTORY_INCREMENTS)) == i), str(i), "arrival")
    return store.read()


GATE_QUESTIONS_SQL = f"""(select question_id, category, type as question_type,
    case cast(question_id % 3 as int) when 0 then 'easy' when 1 then 'medium' else 'hard' end as difficulty from {Q} q)"""


def _gate_sql(attempt: int, published: bool, questions: str, responses: str) -> str:
    enriched = f"(select r.question_id from {responses} r join {questions} q on q.question_id = r.question_id)"
    rows = [("stg_questions", "not_null", c, f"count(*) - count({c})", questions) for c in quality.NOT_NULL["stg_questions"]]
    rows += [("stg_questions", "accepted_values", c, f"count(*) filter ({c} not in ({_in(v)}))", questions) for c, v in quality.ACCEPTED.items()]
    rows += [("stg_questions", "unique", "question_id", "count(*)",
              f"(select question_id from {questions} q where question_id is not null group by 1 having count(*) > 1)")]
    rows += [("stg_ai_responses", "not_null", c, f"count(*) - count({c})", responses) for c in quality.NOT_NULL["stg_ai_responses"]]
    rows += [("stg_responses_enriched", "not_null", "question_id", "count(*) - count(question_id)", enriched)]
    rows += [("stg_ai_responses", "relation", "question_id", "count(*)",
              f"(select 1 from {responses} r where question_id is not null and question_id not in (select question_id from {questions} q))")]
    return " union all ".join(f"select {attempt} as attempt, {str(published).lower()} as published, '{t}' as table_name, '{k}' as check_name, "
                              f"'{c}' as column_name, cast({n} as bigint) as n_failing from {src} x" for t, k, c, n, src in rows)


GATE_SECOND_SQL = f"""(select question_id, category, type as question_type, difficulty from {Q} q where category <> 'Brand#11'
    union all select question_id, nullif(category, 'Brand#12'), type, difficulty from {Q} q where difficulty like '%A%')"""


@register("gold_gate", f"""
select a.*, (select count(*) from {R} r) as visible_responses, (select count(*) from {Q} q) as visible_questions from (
{_gate_sql(1, True, GATE_QUESTIONS_SQL, R)} union all {_gate_sql(2, False, GATE_SECOND_SQL, R)}) a""")
def q_gold_gate(spark, sf):
    """Two attempts to publish the staging models: the first passes its checks; the second has
    unknown difficulties, repeated ids, missing categories and orphans, so the first stays visible."""
    root = f"{_scratch(spark, 'gate')}/gold"
    q, r = A.questions(spark, sf), A.responses(spark, sf)
    third = F.pmod("question_id", F.lit(3))
    good = q.withColumn("difficulty", F.when(third == 0, "easy").when(third == 1, "medium").otherwise("hard"))
    bad = q.where("category <> 'Brand#11'").unionByName(
        q.where("difficulty like '%A%'").withColumn("category", F.expr("nullif(category, 'Brand#12')")))
    out = None
    for attempt, questions in enumerate((good, bad), 1):
        stq = marts.stg_questions(questions)
        tables = {"stg_questions": stq, "stg_ai_responses": marts.stg_ai_responses(r), "stg_responses_enriched": marts.responses_enriched(r, stq)}
        try:
            rows, published = gates.publish_checked(spark, tables, root)[1], True
        except gates.GateFailed as failed:
            rows, published = failed.audit, False
        audit = spark.createDataFrame(rows, gates.AUDIT).select(F.lit(attempt).alias("attempt"), F.lit(published).alias("published"), "*")
        out = audit if out is None else out.unionByName(audit)
    seen = versions.load(spark, root)
    count = lambda name: seen.read(spark, name).agg(F.count(F.lit(1))).scalar()
    return out.select("*", count("stg_ai_responses").alias("visible_responses"), count("stg_questions").alias("visible_questions"))
