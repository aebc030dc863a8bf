"""The core's queries over the test tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import text as X
from dialoom.functions.json_text import canonical_digest, tolerant_json
from dialoom.functions.labels import label_key
from dialoom.operators import checks, dedup, lookups, quota, scoring, transcript
from dialoom.session import Scratch, read_table
from dialoom.sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# --- shared SQL pieces ---------------------------------------------------------------------

_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
_HALF = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")


def label_sql(x: str) -> str:
    return f"lower(regexp_replace(translate({x}, '{_FULL}', '{_HALF}'), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"


_ROLE = f"CASE {label_sql('role')} WHEN 'character' THEN 'assistant' ELSE {label_sql('role')} END"
_TURNS = f"turns AS (SELECT dialogue_id, pos, min(r) AS role, min(content) AS content FROM (SELECT dialogue_id, pos, {_ROLE} AS r, content FROM messages) GROUP BY dialogue_id, pos)"
_PUBLIC = f"{_TURNS}, pub AS (SELECT *, row_number() OVER (PARTITION BY dialogue_id ORDER BY pos) - 1 AS i FROM turns WHERE role IN ('user', 'assistant'))"
_PAIRS = f"{_PUBLIC}, pairs AS (SELECT dialogue_id, CAST(i // 2 + 1 AS INTEGER) AS round, content AS u, a, r2 FROM (SELECT *, lead(content) OVER w AS a, lead(role) OVER w AS r2 FROM pub WINDOW w AS (PARTITION BY dialogue_id ORDER BY i)) WHERE i % 2 = 0 AND role = 'user' AND r2 = 'assistant')"
_DIMS = ", ".join(f"({i}, '{d}', '{p}')" for i, (d, p, _) in enumerate(files.RUBRIC))
_NUM = "('0x' || substr(md5({}), 1, 6))::BIGINT"
_SCORES = (
    f"{_PAIRS}, dims(ord, dimension_id, principle) AS (VALUES {_DIMS}), "
    "tasks AS (SELECT dialogue_id, round, format('{}:round_{:02d}', dialogue_id, round) AS sample_id, ord, dimension_id, principle FROM pairs CROSS JOIN dims), "
    "graded AS (SELECT *, sample_id || ':' || dimension_id || ':' || principle AS task_id FROM tasks), "
    f"scores AS (SELECT *, 1 + 2 * ({_NUM.format('task_id')} % 3) AS score FROM graded WHERE {_NUM.format(repr('done|') + ' || task_id')} % 10 < 9)"
)
_FACTS = (
    "raw AS (SELECT DISTINCT id, unnest(string_split_regex(persona, '\\r\\n|[\\n\\r]')) AS line FROM users), "
    "facts AS (SELECT DISTINCT id, trim(regexp_replace(replace(lower(line), 'cannot', 'can not'), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS fact FROM raw)"
)
_META = (
    f"meta AS (SELECT dialogue_id, min({label_sql('coalesce(nullif(conversation_start.mode, chr(0)), scene.conversation_mode)')}) AS mode, min(character_name) AS character_name FROM transcripts GROUP BY dialogue_id)"
).replace("chr(0)", "''")


def query(sql: str | None):
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- shared inputs -------------------------------------------------------------------------


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return transcript.turns(read_table(spark, d, "messages"))


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return transcript.pairs(_turns(spark, d)).select("dialogue_id", "round")


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    return scoring.task_grid(_samples(spark, d), files.rubric(spark))


def _hash6(c):
    return quota.number_of(c, 6)


def _scores(spark: SparkSession, d: str) -> DataFrame:
    """Stub scores by hash, for aggregates only; nine tenths of the tasks have one."""
    rows = _tasks(spark, d).where(_hash6(F.concat(F.lit("done|"), "task_id")) % 10 < 9)
    return rows.withColumn("score", (1 + 2 * (_hash6(F.col("task_id")) % 3)).cast("bigint"))


def _meta(spark: SparkSession, d: str) -> DataFrame:
    mode = label_key(transcript.mode_of(F.col("conversation_start.mode"), F.col("scene.conversation_mode")))
    return read_table(spark, d, "transcripts").groupBy("dialogue_id").agg(F.min(mode).alias("mode"), F.min("character_name").alias("character_name"))


def _facts(spark: SparkSession, d: str) -> DataFrame:
    # persona facts are in several languages here
    return dedup.facts(read_table(spark, d, "users"), "id", F.col("persona"), r"\p{L}\p{N}")


# --- turns ---------------------------------------------------------------------------------


@query(f"WITH {_PAIRS} SELECT dialogue_id, round, u AS user, a AS assistant FROM pairs")
def turn_pairs(spark: SparkSession, d: str) -> DataFrame:
    """W2, P18."""
    return transcript.pairs(_turns(spark, d))


@query(
    f"""WITH {_TURNS}, s AS (SELECT dialogue_id, coalesce(bool_or(pos = 0 AND role = 'system'), false) AS has_header,
    coalesce(bool_and(CASE WHEN pos > 0 THEN role = CASE WHEN pos % 2 = 1 THEN 'user' ELSE 'assistant' END END), false) AS alternates,
    count(*) FILTER (pos > 0) % 2 = 0 AS complete, coalesce(bool_or(pos > 0 AND (content IS NULL OR NOT regexp_matches(content, '[^\\s\\p{{Z}}\\x{{85}}]'))), false) AS has_blank,
    max(pos) + 1 = count(*) AS gapless, count(*) FILTER (pos > 0) AS n_messages FROM turns GROUP BY dialogue_id)
    SELECT * FROM s WHERE NOT (has_header AND alternates AND complete AND NOT has_blank AND gapless AND n_messages > 0)"""
)
def shape_violations(spark: SparkSession, d: str) -> DataFrame:
    """P14."""
    return transcript.shape(_turns(spark, d)).where("NOT ok").drop("ok")


@query(f"WITH {_TURNS} SELECT dialogue_id, count(*) // 2 AS rounds FROM turns WHERE role IN ('user', 'assistant') GROUP BY dialogue_id")
def rounds_per_dialogue(spark: SparkSession, d: str) -> DataFrame:
    """G14."""
    return transcript.rounds(_turns(spark, d))


@query(f"WITH {_PUBLIC} SELECT dialogue_id, count(*) AS message_count, arg_max(struct_pack(c := content), pos).c AS pending_message FROM pub GROUP BY dialogue_id HAVING count(*) % 2 = 1")
def pending_message(spark: SparkSession, d: str) -> DataFrame:
    """P20, W5."""
    return transcript.pending(_turns(spark, d))


@query(
    f"""WITH {_PUBLIC}, l AS (SELECT *, (i + 1) || '. ' || CASE WHEN role = 'user' THEN '用户' ELSE '角色' END || '：' || coalesce(content, '') AS line FROM pub)
    SELECT * FROM (SELECT dialogue_id, CAST(i // 2 + 1 AS INTEGER) AS round, string_agg(line, chr(10)) OVER (PARTITION BY dialogue_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history, content AS model_response, i FROM l) WHERE i % 2 = 1"""
    .replace("SELECT * FROM (", "SELECT dialogue_id, round, history, model_response FROM (")
)
def reply_with_history(spark: SparkSession, d: str) -> DataFrame:
    """S7, W1, W3."""
    rows = transcript.reply_samples(_turns(spark, d))
    return rows.select("dialogue_id", "round", transcript.history_text(F.col("history")).alias("history"), "model_response")


@query(f"WITH {_TURNS} SELECT dialogue_id, pos, role, coalesce(content, '') AS content, CAST(role = 'assistant' AS INTEGER) AS loss_mask FROM turns")
def training_rows_masked(spark: SparkSession, d: str) -> DataFrame:
    """F21."""
    return transcript.masked_turns(_turns(spark, d))


@query(
    f"""WITH {_TURNS}, m AS (SELECT dialogue_id, list(struct_pack(r := role, c := coalesce(content, '')) ORDER BY pos) AS ms FROM turns GROUP BY dialogue_id)
    SELECT min(dialogue_id) AS dialogue_id, count(*) AS copies FROM m GROUP BY ms"""
)
def training_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The exported dialogue of each distinct message list, and how many it stands for."""
    rows = transcript.training_rows(_turns(spark, d))
    return rows.groupBy(F.sha2(F.to_json("messages"), 256).alias("fp")).agg(F.min("dialogue_id").alias("dialogue_id"), F.count("*").alias("copies")).drop("fp")


@query(f"WITH {_PUBLIC} SELECT dialogue_id, i, CASE WHEN role = 'assistant' THEN 'assistant' ELSE 'user' END AS seen_as, content FROM pub")
def perspective_swap(spark: SparkSession, d: str) -> DataFrame:
    """the turns as the character sees them."""
    rows = transcript.public_turns(_turns(spark, d))
    said = F.array_sort(F.collect_list(F.struct("i", F.when(F.col("role") == "user", "user").otherwise("character").alias("speaker"), "content")))
    per = rows.groupBy("dialogue_id").agg(said.alias("said"))
    seen = transcript.perspective(F.col("said"), "character")
    return per.select("dialogue_id", F.posexplode(seen).alias("i", "m")).select("dialogue_id", F.col("i").cast("bigint").alias("i"), F.col("m.role").alias("seen_as"), "m.content")


@query(f"WITH {_TURNS} SELECT role, count(*) AS messages, count(DISTINCT dialogue_id) AS dialogues, sum(length(coalesce(content, '')))::BIGINT AS characters FROM turns GROUP BY role")
def role_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _turns(spark, d).groupBy("role").agg(F.count("*").alias("messages"), F.countDistinct("dialogue_id").alias("dialogues"), F.sum(F.length(F.coalesce("content", F.lit("")))).alias("characters"))


@query(f"WITH {_PUBLIC}, n AS (SELECT dialogue_id, count(*) // 2 AS rounds FROM pub GROUP BY dialogue_id) SELECT dialogue_id, CASE WHEN rounds >= 8 THEN 'max_turns' END AS stop_reason, rounds FROM n")
def stop_by_rounds(spark: SparkSession, d: str) -> DataFrame:
    """T2 with eight rounds at most and no goal flags."""
    rows = transcript.rounds(_turns(spark, d))
    return rows.select("dialogue_id", F.try_element_at(transcript.stop_reasons(F.lit(False), F.col("rounds"), 8), F.lit(1)).alias("stop_reason"), "rounds")


# --- quotas and plans ----------------------------------------------------------------------

_W = {"mode": {"task": Decimal("0.2"), "topic_chat": Decimal("0.4"), "open_chat": Decimal("0.4")}, "tone": {"neutral": Decimal("0.4"), "gentle": Decimal("0.2"), "sharp": Decimal("0.4")}}
_AXES = "(VALUES ('mode','task',0,2),('mode','topic_chat',1,4),('mode','open_chat',2,4),('tone','neutral',0,4),('tone','gentle',1,2),('tone','sharp',2,4)) t(axis,key,ord,w)"


@query(
    f"""WITH q AS (SELECT axis, key, ord, n, n * w // 10 AS f, n * w % 10 AS r FROM {_AXES} CROSS JOIN range(1, 101) x(n)),
    p AS (SELECT *, row_number() OVER (PARTITION BY axis, n ORDER BY r DESC, ord) AS place, n - sum(f) OVER (PARTITION BY axis, n) AS rest FROM q)
    SELECT axis, n, key, CAST(f + CASE WHEN place <= rest THEN 1 ELSE 0 END AS BIGINT) AS seats FROM p"""
)
def quota_axes(spark: SparkSession, d: str) -> DataFrame:
    """A1, A2 for every count from 1 to 100."""
    rows = quota.weights_table(spark, _W).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(100)).cast("array<bigint>")))
    return quota.largest_remainder(rows, ["axis", "n"]).select("axis", "n", "key", "seats")


def _seats_sql(n: int) -> str:
    """Seats of the two axes by largest remainders, in SQL."""
    return (
        f"q AS (SELECT axis, key, ord, {n} * w // 10 AS f, {n} * w % 10 AS r FROM {_AXES}), p AS (SELECT *, row_number() OVER (PARTITION BY axis ORDER BY r DESC, ord) AS place, {n} - sum(f) OVER (PARTITION BY axis) AS rest FROM q), "
        "s AS (SELECT axis, key, CAST(f + CASE WHEN place <= rest THEN 1 ELSE 0 END AS BIGINT) AS seats FROM p)"
    )


@query(f"WITH {_seats_sql(100)} SELECT axis, key, seats FROM s")
def quota_two_way(spark: SparkSession, d: str) -> DataFrame:
    """A3: both margins of the two-way table."""
    table = quota.two_way(quota.quota(100, _W["mode"]), quota.quota(100, _W["tone"]), "quota_behavior:7")
    rows = spark.createDataFrame([(m, t, n) for m, r in table.items() for t, n in r.items()], "mode string, tone string, n bigint")
    return rows.groupBy(F.lit("mode").alias("axis"), F.col("mode").alias("key")).agg(F.sum("n").alias("seats")).unionByName(
        rows.groupBy(F.lit("tone").alias("axis"), F.col("tone").alias("key")).agg(F.sum("n").alias("seats"))
    )


def _plan(spark: SparkSession, d: str, count: int = 700, seed: int = 7) -> DataFrame:
    named = lambda t, *c: read_table(spark, d, t).select("id", *c)
    return quota.plan_jobs(named("users"), named("topics", "seeds"), named("characters"), count, seed, _W["mode"], _W["tone"])


@query(f"WITH {_seats_sql(700)} SELECT axis, key, seats AS target, seats AS actual FROM s")
def plan_margins(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual of a plan of 700."""
    return quota.plan_summary(_plan(spark, d), {a: quota.quota(700, w) for a, w in _W.items()})


@query(
    f"""WITH {_seats_sql(700)}, m AS (SELECT CAST(sum(seats) AS INTEGER) AS jobs, CAST(sum(seats) FILTER (key <> 'open_chat') AS INTEGER) AS with_topic, CAST(sum(seats) FILTER (key = 'task') AS INTEGER) AS with_situation FROM s WHERE axis = 'mode')
    SELECT jobs, jobs AS ids, jobs AS combinations, jobs AS known_users, jobs AS known_characters, with_topic, with_situation FROM m"""
)
def plan_contracts(spark: SparkSession, d: str) -> DataFrame:
    """Ids and combinations are distinct, references resolve, situations come with tasks only."""
    p = Scratch(spark, "plan").table(_plan(spark, d))
    users, chars, topics = (read_table(spark, d, t).select(F.col("id").alias("x")).distinct() for t in ("users", "characters", "topics"))
    known = p.join(users.withColumnRenamed("x", "user_id").withColumn("u", F.lit(1)), "user_id", "left")
    known = known.join(chars.withColumnRenamed("x", "character_id").withColumn("c", F.lit(1)), "character_id", "left")
    known = known.join(topics.withColumnRenamed("x", "topic_id").withColumn("t", F.lit(1)), "topic_id", "left")
    combo = F.to_json(F.struct("mode", "user_id", "topic_id", "character_id"))
    return known.agg(
        F.count("*").cast("int").alias("jobs"), F.countDistinct("id").cast("int").alias("ids"), F.countDistinct(combo).cast("int").alias("combinations"),
        F.sum("u").cast("int").alias("known_users"), F.sum("c").cast("int").alias("known_characters"), F.sum("t").cast("int").alias("with_topic"),
        F.count_if(F.col("seed_situation").isNotNull() & (F.col("mode") == "task")).cast("int").alias("with_situation"),
    )


@query(None)
def plan_jobs(spark: SparkSession, d: str) -> DataFrame:
    """The plan itself."""
    return _plan(spark, d)


@query("SELECT mode, users * characters * CASE WHEN mode = 'open_chat' THEN 1 ELSE topics END AS capacity FROM (SELECT (SELECT count(DISTINCT id) FROM users) AS users, (SELECT count(DISTINCT id) FROM characters) AS characters, (SELECT count(DISTINCT id) FROM topics) AS topics) CROSS JOIN (VALUES ('task'), ('topic_chat'), ('open_chat')) m(mode)")
def plan_capacity(spark: SparkSession, d: str) -> DataFrame:
    """A4: combinations there are, by mode, from three counts."""
    counts = None
    for i, t in enumerate(("users", "characters", "topics")):
        one = read_table(spark, d, t).agg(F.countDistinct("id").alias("n")).withColumn("t", F.lit(t))
        counts = one if counts is None else counts.unionByName(one)
    wide = counts.groupBy().pivot("t", ["users", "characters", "topics"]).agg(F.first("n"))
    each = F.explode(F.array(*[F.lit(m) for m in ("task", "topic_chat", "open_chat")]))
    return wide.select("*", each.alias("mode")).select("mode", (F.col("users") * F.col("characters") * F.when(F.col("mode") == "open_chat", F.lit(1)).otherwise(F.col("topics"))).alias("capacity"))


@query("SELECT tone, count(p) AS presets FROM (VALUES ('neutral'), ('gentle'), ('sharp')) t(tone) LEFT JOIN (VALUES ('a', 'neutral'), ('b', 'neutral'), ('c', 'sharp')) x(p, tone) USING (tone) GROUP BY tone HAVING count(p) <> 1")
def preset_coverage(spark: SparkSession, d: str) -> DataFrame:
    """A5."""
    return quota.preset_problems(spark.createDataFrame([("a", "neutral"), ("b", "neutral"), ("c", "sharp")], "id string, tone string"), {"neutral": 2, "gentle": 1, "sharp": 2})


@query(
    "WITH t AS (SELECT id, max(seeds) AS seeds FROM topics GROUP BY id) "
    "SELECT id, list_extract(seeds, 1 + ('0x' || substr(md5('seed_situation:7|' || id), 1, 13))::BIGINT % len(seeds)) AS seed FROM t WHERE len(seeds) > 0"
)
def seed_choice(spark: SparkSession, d: str) -> DataFrame:
    """A7, A10."""
    rows = read_table(spark, d, "topics").groupBy("id").agg(F.max("seeds").alias("seeds")).where(F.size("seeds") > 0)
    return rows.select("id", quota.choose_from(F.col("seeds"), "seed_situation:7", F.col("id")).alias("seed"))


@query("SELECT id, list_extract(['neutral', 'gentle', 'sharp'], 1 + ('0x' || substr(md5('user_behaviors:7|' || id), 1, 13))::BIGINT % 3) AS tone FROM (SELECT DISTINCT dialogue_id AS id FROM jobs)")
def preset_choice(spark: SparkSession, d: str) -> DataFrame:
    """A8."""
    tones = F.array(F.lit("neutral"), F.lit("gentle"), F.lit("sharp"))
    return read_table(spark, d, "jobs").select(F.col("dialogue_id").alias("id")).distinct().withColumn("tone", quota.choose_from(tones, "user_behaviors:7", F.col("id")))


@query("SELECT id, row_number() OVER (ORDER BY md5('quota_order:7|' || id), id) AS place FROM (SELECT DISTINCT dialogue_id AS id FROM jobs)")
def seeded_shuffle(spark: SparkSession, d: str) -> DataFrame:
    """A global shuffle whose places are exact and yet not ranked in one task."""
    from dialoom.operators.ranks import random_rank

    ids = read_table(spark, d, "jobs").select(F.col("dialogue_id").alias("id")).distinct()
    return random_rank(ids, [], ["id"], "", "place", hex_order=quota.salted_order("quota_order:7", F.col("id"))).select("id", F.col("place").cast("bigint").alias("place"))


@query("SELECT n + 1 AS next_number, format('dialogue_{:05d}', n + 1) AS next_id FROM (SELECT max(CAST(regexp_extract(dialogue_id, '^dialogue_(\\d+)$', 1) AS BIGINT)) AS n FROM jobs)")
def id_max_next(spark: SparkSession, d: str) -> DataFrame:
    """A11, A12."""
    return quota.next_number(read_table(spark, d, "jobs"))


@query("SELECT user_source, min(dialogue_id) AS first_id, max(dialogue_id) AS last_id, count(DISTINCT dialogue_id) AS n FROM jobs GROUP BY user_source")
def batch_bounds(spark: SparkSession, d: str) -> DataFrame:
    """W6, O5."""
    return read_table(spark, d, "jobs").groupBy("user_source").agg(F.min("dialogue_id").alias("first_id"), F.max("dialogue_id").alias("last_id"), F.countDistinct("dialogue_id").alias("n"))


# --- scores --------------------------------------------------------------------------------


@query(f"WITH {_SCORES} SELECT task_id, sample_id, dimension_id, principle FROM graded")
def task_grid(spark: SparkSession, d: str) -> DataFrame:
    """J5, F9."""
    return _tasks(spark, d).select("task_id", "sample_id", "dimension_id", "principle")


@query(f"WITH {_SCORES.replace('tasks AS (', 'tasks AS MATERIALIZED (').replace('graded AS (', 'graded AS MATERIALIZED (')} SELECT task_id FROM graded g WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.task_id = g.task_id)")
def pending_tasks(spark: SparkSession, d: str) -> DataFrame:
    """J6, T5, T8."""
    return scoring.pending_tasks(_tasks(spark, d), _scores(spark, d)).select("task_id")


_AGG = "sum(n)::BIGINT AS n_scores, round_even(sum(s) / sum(n), 6) AS mean_score, sum(c1)::BIGINT AS n_score_1, sum(c3)::BIGINT AS n_score_3, sum(c5)::BIGINT AS n_score_5, round_even(avg(s / n), 6) AS macro_mean"
_PER = "count(*) AS n, sum(score)::DOUBLE AS s, count(*) FILTER (score = 1) AS c1, count(*) FILTER (score = 3) AS c3, count(*) FILTER (score = 5) AS c5"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({"mean_score": F.bround("mean_score", 6), "macro_mean": F.bround("macro_mean", 6)})


@query(f"WITH {_SCORES}, per AS (SELECT principle, dialogue_id, {_PER} FROM scores GROUP BY ALL) SELECT principle, {_AGG} FROM per GROUP BY principle")
def score_macro_mean(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: pairs, task grid, scores, micro and macro means per principle."""
    return _rounded(scoring.aggregate(_scores(spark, d)))


@query(
    f"""WITH {_SCORES}, {_META}, j AS (SELECT s.*, m.mode, m.character_name FROM scores s JOIN meta m USING (dialogue_id)),
    u AS (SELECT 'all' AS grouping, '' AS key, * FROM j UNION ALL SELECT 'mode', mode, * FROM j UNION ALL SELECT 'character', character_name, * FROM j),
    per AS (SELECT grouping, key, principle, dialogue_id, {_PER} FROM u GROUP BY ALL) SELECT grouping, key, principle, {_AGG} FROM per GROUP BY ALL"""
)
def score_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Overall, by mode and by character name, in one plan."""
    rows = _scores(spark, d).join(_meta(spark, d), "dialogue_id")
    return _rounded(scoring.aggregate_sets(rows, {"mode": "mode", "character": "character_name"}))


@query(f"WITH {_SCORES} SELECT dialogue_id, round_even(avg(score), 4) AS average_score, count(*) AS n_scores FROM scores GROUP BY dialogue_id")
def dialogue_average(spark: SparkSession, d: str) -> DataFrame:
    """G4, F16, T14."""
    return scoring.dialogue_average(_scores(spark, d))


@query(
    f"""WITH {_SCORES}, w AS (SELECT dialogue_id, count(*) * 7 AS expected FROM pairs GROUP BY dialogue_id), g AS (SELECT dialogue_id, count(*) AS completed FROM scores GROUP BY dialogue_id)
    SELECT dialogue_id, expected, coalesce(completed, 0) AS completed, expected = coalesce(completed, 0) AS complete FROM w LEFT JOIN g USING (dialogue_id)"""
)
def dialogue_completion(spark: SparkSession, d: str) -> DataFrame:
    """G5."""
    return scoring.completion(_samples(spark, d), _scores(spark, d), 7)


@query(f"WITH {_SCORES} SELECT sample_id FROM scores GROUP BY sample_id HAVING count(*) = 7")
def fully_scored(spark: SparkSession, d: str) -> DataFrame:
    """G6."""
    return scoring.fully_scored(_scores(spark, d), 7)


@query(f"WITH {_SCORES}, {_META} SELECT mode, count(DISTINCT p.dialogue_id) AS dialogues, count(*) AS turns FROM pairs p JOIN meta USING (dialogue_id) GROUP BY mode")
def turns_by_mode(spark: SparkSession, d: str) -> DataFrame:
    """G7, P12."""
    return _samples(spark, d).join(_meta(spark, d), "dialogue_id").groupBy("mode").agg(F.countDistinct("dialogue_id").alias("dialogues"), F.count("*").alias("turns"))


@query(f"WITH {_SCORES} SELECT dialogue_id, round, string_agg(principle || '=' || score, ',' ORDER BY ord) AS items FROM scores GROUP BY dialogue_id, round")
def inline_scores(spark: SparkSession, d: str) -> DataFrame:
    """Nested by round in rubric order, and read back."""
    nested = scoring.inline_scores(_scores(spark, d).withColumn("reason", F.lit("stub")))
    rows = nested.select("dialogue_id", F.explode("scores").alias("k", "v"))
    items = F.array_join(F.transform("v", lambda x: F.concat(x["dimension"], F.lit("="), x["score"].cast("string"))), ",")
    return rows.select("dialogue_id", F.substring("k", 7, 9).cast("int").alias("round"), items.alias("items"))


@query(f"WITH {_SCORES} SELECT task_id, score, (1 + 2 * ({_NUM.format(repr('new|') + ' || task_id')} % 3)) AS new_score FROM scores WHERE score <> 1 + 2 * ({_NUM.format(repr('new|') + ' || task_id')} % 3)")
def score_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """A second batch for the same tasks, and where it contradicts the first."""
    old = _scores(spark, d).withColumn("reason", F.lit("stub"))
    new = old.withColumn("score", (1 + 2 * (_hash6(F.concat(F.lit("new|"), "task_id")) % 3)).cast("bigint"))
    return scoring.merge_scores(old, new)[1]


@query(
    f"""WITH m AS (SELECT dialogue_id, min(scene.background) AS b, min(scene.trigger) AS t FROM transcripts GROUP BY dialogue_id)
    SELECT dialogue_id FROM m WHERE NOT ({_NUM.format('dialogue_id')} % 5 = 0)"""
)
def score_retention(spark: SparkSession, d: str) -> DataFrame:
    """A fifth of the dialogues change their scene; the scores of the others stay."""
    old = read_table(spark, d, "transcripts").groupBy("dialogue_id").agg(F.min("scene.background").alias("b"), F.min("scene.trigger").alias("t"))
    new = old.withColumn("t", F.when(_hash6(F.col("dialogue_id")) % 5 == 0, F.concat(F.coalesce("t", F.lit("")), F.lit(" (edited)"))).otherwise(F.col("t")))
    return scoring.retained(old, new, ["b", "t"])


@query(f"WITH {_SCORES} SELECT sample_id, score FROM scores WHERE principle = '风格一致' ORDER BY sample_id LIMIT 100")
def first_replies(spark: SparkSession, d: str) -> DataFrame:
    """O1: a limit in file and round order, the feature itself; a top-k, no sort of all rows."""
    return _scores(spark, d).where("principle = '风格一致'").select("sample_id", "score").orderBy("sample_id").limit(100)


# --- profiles ------------------------------------------------------------------------------


@query(f"WITH {_FACTS} SELECT id, fact FROM facts")
def fact_normalized(spark: SparkSession, d: str) -> DataFrame:
    """F6, F7."""
    return _facts(spark, d)


_OVER = (
    f"{_FACTS}, n AS (SELECT id, count(*) AS n FROM facts GROUP BY id), o AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM facts a JOIN facts b ON a.fact = b.fact AND a.id < b.id GROUP BY ALL), "
    "pairs AS (SELECT o.* FROM o JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE common >= 3 OR common = least(x.n, y.n))"
)


_CLASSES = "sets AS (SELECT id, list_sort(list(fact)) AS fs FROM facts GROUP BY id), reps AS (SELECT fs, min(id) AS rep FROM sets GROUP BY fs)"


@query(f"WITH {_FACTS}, {_CLASSES} SELECT id, rep FROM sets JOIN reps USING (fs)")
def fact_copies(spark: SparkSession, d: str) -> DataFrame:
    """Profiles with exactly the same facts, by their smallest id."""
    return dedup.fact_classes(_facts(spark, d))


@query(f"WITH {_OVER}, {_CLASSES} SELECT a, b, common FROM pairs WHERE a IN (SELECT rep FROM reps) AND b IN (SELECT rep FROM reps)")
def fact_overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Between the representatives of ``fact_copies``."""
    return dedup.overlap_pairs(_facts(spark, d))


_COMP = (
    f"WITH RECURSIVE {_OVER}, e AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs UNION SELECT id, id FROM n), "
    "reach(x, y) AS (SELECT a, b FROM e UNION SELECT r.x, e.b FROM reach r JOIN e ON r.y = e.a), comp AS (SELECT x AS id, min(y) AS component FROM reach GROUP BY x)"
)


@query(f"{_COMP} SELECT id, component FROM comp")
def dedup_components(spark: SparkSession, d: str) -> DataFrame:
    """G13, by sets of three facts instead of pairs."""
    return dedup.profile_groups(_facts(spark, d))


@query(
    f"{_COMP}, place AS (SELECT id, min(coalesce(source_row_index, 2147483647)) AS ord FROM users GROUP BY id), "
    "r AS (SELECT component, id, row_number() OVER (PARTITION BY component ORDER BY n.n DESC, ord, id) AS k, count(*) OVER (PARTITION BY component) AS members FROM comp JOIN n USING (id) JOIN place USING (id)) "
    "SELECT component, id, members FROM r WHERE k = 1"
)
def dedup_representatives(spark: SparkSession, d: str) -> DataFrame:
    """G12."""
    f = _facts(spark, d)
    order = read_table(spark, d, "users").groupBy("id").agg(F.min(F.coalesce("source_row_index", F.lit(2147483647))).alias("ord"))
    return dedup.representatives(dedup.profile_groups(f), f, order)


@query(None)
def dedup_ordered(spark: SparkSession, d: str) -> DataFrame:
    """The incremental variant, which ends by definition at fifty distinct profiles."""
    return dedup.ordered_fold(read_table(spark, d, "users").where("source_row_index IS NOT NULL"), "source_row_index", "id", "persona", keep=r"\p{L}\p{N}")


# --- catalogue -----------------------------------------------------------------------------


@query("SELECT 'users' AS catalogue, id, count(*) AS n FROM users GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'topics', id, count(*) FROM topics GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'characters', id, count(*) FROM characters GROUP BY id HAVING count(*) > 1")
def constraint_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    """P6."""
    out = None
    for t in ("users", "topics", "characters"):
        one = checks.repeated_keys(read_table(spark, d, t), "id").select(F.lit(t).alias("catalogue"), "id", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT (SELECT count(DISTINCT id) FROM users) AS users, (SELECT count(DISTINCT id) FROM topics) AS topics, (SELECT count(DISTINCT group_id) FROM topics) AS topic_groups, (SELECT count(DISTINCT id) FROM characters) AS characters")
def catalogue_counts(spark: SparkSession, d: str) -> DataFrame:
    """G11."""
    rows = None
    for name, t, c in (("users", "users", "id"), ("topics", "topics", "id"), ("topic_groups", "topics", "group_id"), ("characters", "characters", "id")):
        one = read_table(spark, d, t).select(F.lit(name).alias("k"), F.col(c).alias("v")).distinct()
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy().pivot("k", ["users", "topics", "topic_groups", "characters"]).agg(F.count("v"))


@query("SELECT DISTINCT j.job.user.id AS id, 'missing' AS problem FROM jobs j WHERE j.job.user.id IS NOT NULL AND j.job.user.id NOT IN (SELECT id FROM users)")
def lookup_missing(spark: SparkSession, d: str) -> DataFrame:
    """User ids, taken literally, without a catalogue row."""
    rows = read_table(spark, d, "jobs").select(F.col("job.user.id").alias("id")).where("id IS NOT NULL").distinct()
    return lookups.lookup(rows, read_table(spark, d, "users").select("id").distinct(), "id")[1]


@query("SELECT dialogue_id FROM (SELECT DISTINCT dialogue_id FROM jobs) j WHERE dialogue_id NOT IN (SELECT dialogue_id FROM transcripts)")
def jobs_without_transcript(spark: SparkSession, d: str) -> DataFrame:
    """J3, S9."""
    return read_table(spark, d, "jobs").select("dialogue_id").distinct().join(read_table(spark, d, "transcripts"), "dialogue_id", "left_anti")


@query("SELECT dialogue_id FROM jobs UNION SELECT dialogue_id FROM transcripts UNION SELECT dialogue_id FROM messages")
def job_ids_union(spark: SparkSession, d: str) -> DataFrame:
    """S10, U1."""
    ids = [read_table(spark, d, t).select("dialogue_id") for t in ("jobs", "transcripts", "messages")]
    return files.job_ids(ids[0].union(ids[1]), ids[2])


@query("SELECT id, name, mode, group_id, unnest(seeds) AS seed FROM (SELECT DISTINCT id, name, mode, group_id, seeds FROM topics)")
def topic_seeds(spark: SparkSession, d: str) -> DataFrame:
    """S4."""
    return read_table(spark, d, "topics").select("id", "name", "mode", "group_id", "seeds").distinct().select("id", "name", "mode", "group_id", F.explode("seeds").alias("seed"))


@query("SELECT id, json_exists(profile, '$.goal') OR json_exists(profile, '$.scene') OR json_exists(profile, '$.topic') OR json_exists(profile, '$.habit') AS holds, list_sort(json_keys(profile)) = ['habit', 'name', 'trait'] AS plain FROM characters")
def profile_keys(spark: SparkSession, d: str) -> DataFrame:
    """P4, P7 over the open profiles."""
    return read_table(spark, d, "characters").select("id", checks.holds_forbidden(F.col("profile"), ("goal", "scene", "topic", "habit")).alias("holds"), checks.exact_keys(F.col("profile"), ["name", "trait", "habit"]).alias("plain"))


@query("SELECT id, json_extract_string(profile, '$.name') AS profile_name, coalesce(nullif(json_extract_string(profile, '$.name'), ''), name) AS catalogue_name FROM characters")
def name_precedence(spark: SparkSession, d: str) -> DataFrame:
    """P13, F12."""
    profile = F.try_parse_json("profile")
    return read_table(spark, d, "characters").select("id", F.try_variant_get(profile, "$.name", "string").alias("profile_name"), transcript.character_name(F.col("name"), profile, catalogue=True).alias("catalogue_name"))


@query(None)
def profile_digest(spark: SparkSession, d: str) -> DataFrame:
    """F1, S3: digests of the open profiles in canonical form."""
    return read_table(spark, d, "characters").select("id", canonical_digest(F.col("profile")).alias("digest"))


@query(
    """WITH t AS (SELECT DISTINCT id, name, mode, boundary, seeds FROM topics), s AS (SELECT id, m AS mode, CASE WHEN m <> 'open_chat' THEN name END AS background, CASE WHEN m = 'task' THEN list_extract(seeds, 1) END AS trigger,
    CASE WHEN m = 'task' THEN coalesce(boundary, '') ELSE '' END AS boundary, CASE WHEN m = 'task' THEN list_extract(seeds, 1) END AS user_goal FROM t CROSS JOIN (VALUES ('task'), ('topic_chat'), ('open_chat')) x(m))
    SELECT *, CASE mode WHEN 'task' THEN coalesce(trim(background) <> '' AND trim(trigger) <> '' AND trim(user_goal) <> '', false) ELSE true END AS valid FROM s"""
)
def scene_by_mode(spark: SparkSession, d: str) -> DataFrame:
    """The scene of each topic in each mode."""
    t = read_table(spark, d, "topics").select("id", "name", "boundary", "seeds").distinct()
    rows = t.withColumn("m", F.explode(F.array(*[F.lit(m) for m in ("task", "topic_chat", "open_chat")])))
    first = F.try_element_at("seeds", F.lit(1))
    s = transcript.scene(F.col("m"), F.col("name"), first, F.col("boundary"), first)
    out = rows.select("id", s.alias("s")).select("id", F.col("s.conversation_mode").alias("mode"), "s.background", "s.trigger", "s.boundary", "s.user_goal")
    return out.withColumn("valid", transcript.scene_valid(F.col("mode"), F.col("background"), F.col("trigger"), F.col("user_goal")))


@query("SELECT status, phase, count(DISTINCT dialogue_id) AS jobs, sum(rounds)::BIGINT AS rounds FROM (SELECT DISTINCT dialogue_id, status, phase, rounds FROM jobs) GROUP BY status, phase")
def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    """G8, P10."""
    return read_table(spark, d, "jobs").select("dialogue_id", "status", "phase", "rounds").distinct().groupBy("status", "phase").agg(F.countDistinct("dialogue_id").alias("jobs"), F.sum("rounds").alias("rounds"))


@query("SELECT event_type, count(*) AS attempts, count(DISTINCT user_id) AS users, round_even(sum(value), 2) AS total FROM events GROUP BY event_type")
def event_rollup(spark: SparkSession, d: str) -> DataFrame:
    """G8, G9 over the event table."""
    return read_table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("attempts"), F.countDistinct("user_id").alias("users"), F.bround(F.sum("value"), 2).alias("total"))


@query("SELECT dialogue_id, status IN ('completed', 'accepted') AS kept FROM (SELECT DISTINCT dialogue_id, status FROM jobs)")
def status_filter(spark: SparkSession, d: str) -> DataFrame:
    """P10, P5: what scoring and export keep, and what they skip."""
    good, rest = checks.finished(read_table(spark, d, "jobs").select("dialogue_id", "status").distinct())
    return good.select("dialogue_id", F.lit(True).alias("kept")).unionByName(rest.select("dialogue_id", F.lit(False).alias("kept")))


@query("SELECT id, 'Persona of ' || id || ' in version ' || version || ': ' || persona || ' ($' || 'x)' AS prompt FROM (SELECT DISTINCT id, version, persona FROM users)")
def template_prompt(spark: SparkSession, d: str) -> DataFrame:
    """F8, F19."""
    rows = read_table(spark, d, "users").select("id", "version", "persona").distinct()
    return rows.select("id", X.fill_template("Persona of $id in version $version: $persona ($$x)", {c: F.col(c) for c in rows.columns}).alias("prompt"))


@query("SELECT id, length(replace(persona, chr(10), '')) BETWEEN 85 AND 115 AS in_bounds, len(list_filter(string_split(persona, chr(10)), lambda x: starts_with(x, '我'))) > 0 AS starts FROM (SELECT DISTINCT id, persona FROM users)")
def persona_checks(spark: SparkSession, d: str) -> DataFrame:
    """F13, F14."""
    rows = read_table(spark, d, "users").select("id", "persona").distinct()
    return rows.select("id", X.visible_length_between(F.col("persona")).alias("in_bounds"), X.any_line_starts(F.col("persona"), "我").alias("starts"))


@query("SELECT name, trim(split_part(split_part(name, '（', 1), ';', 1)) AS display, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS squeezed FROM (SELECT DISTINCT name || '（旧）; x' AS name FROM characters)")
def display_names(spark: SparkSession, d: str) -> DataFrame:
    """F2, F10."""
    rows = read_table(spark, d, "characters").select(F.concat("name", F.lit("（旧）; x")).alias("name")).distinct()
    return rows.select("name", X.display_name(F.col("name")).alias("display"), X.squeeze(F.col("name")).alias("squeezed"))


# model replies made from each topic's id, by kind: the text around the id, and what a tolerant reader finds in it
_REPLIES = [
    ('{"a": "', '"}', True), ('```json\n{"a": "', '"}\n```', True), ('Sure: {"a": "', '"} done', True), ('["', '"]', False), ('x [1] {"a": "', '"}', False), ('{"a": "', '"} {"b": 2}', False), ('{"a": "', '"', False),
]
_KIND = "(" + _NUM.format("'reply|' || id") + f" % {len(_REPLIES)})"


def _made(kinds: list[tuple[str, ...]], kind, *middle):
    """The text of each row's kind."""
    out = F.lit(None).cast("string")
    for i, k in enumerate(kinds):
        out = F.when(kind == i, F.concat(F.lit(k[0]), *middle, F.lit(k[1]))).otherwise(out)
    return out


@query(f"SELECT DISTINCT id, CASE WHEN {_KIND} IN ({', '.join(str(i) for i, r in enumerate(_REPLIES) if r[2])}) THEN id END AS parsed FROM topics")
def tolerant_replies(spark: SparkSession, d: str) -> DataFrame:
    """F3 on model replies of every kind."""
    ids = read_table(spark, d, "topics").select("id").distinct()
    raw = _made(_REPLIES, _hash6(F.concat(F.lit("reply|"), "id")) % len(_REPLIES), F.col("id"))
    return ids.select("id", F.get_json_object(tolerant_json(raw), "$.a").alias("parsed"))


# judges' replies for each task, by kind: before and behind the principle, and whether they are valid
_JUDGED = [
    ('{"', '": {"score": 3, "reason": "ok"}}', True), ('{"', '": {"score": 2, "reason": "ok"}}', False), ('{"', '": {"score": 3.0, "reason": "ok"}}', False), ('{"', '": {"score": "5", "reason": "ok"}}', False),
    ('{"', '": {"score": true, "reason": "ok"}}', False), ('{"', '": {"score": 5, "reason": " "}}', False), ('{"', '": {"score": 5, "reason": 12}}', False), ('{"', '": {"score": 5, "reason": "x", "more": 1}}', False),
    ('{"other', '": {"score": 5, "reason": "x"}}', False), ('{"other": {"score": 5, "reason": "x"}, "', '": {"score": 5, "reason": "x"}}', False), ('{"', '": {"score": 1, "reason": "no"}}', True), ('[{"', '": {"score": 1, "reason": "no"}}]', False),
]


@query(f"WITH {_SCORES} SELECT task_id, {_NUM.format(repr('judge|') + ' || task_id')} % {len(_JUDGED)} IN ({', '.join(str(i) for i, j in enumerate(_JUDGED) if j[2])}) AS valid FROM graded WHERE ord = 0")
def strict_scores(spark: SparkSession, d: str) -> DataFrame:
    """One judge's reply for each sample."""
    rows = _tasks(spark, d).where("ord = 0")
    raw = _made(_JUDGED, _hash6(F.concat(F.lit("judge|"), "task_id")) % len(_JUDGED), F.col("principle"))
    return rows.select("task_id", scoring.valid_scores(raw, [files.RUBRIC[0][1]]).isNotNull().alias("valid"))


@query(f"WITH {_SCORES} SELECT dialogue_id, round, dimension_id, CAST(score AS INTEGER) AS score FROM scores")
def inline_back(spark: SparkSession, d: str) -> DataFrame:
    """Nested scores read back as facts, principles by the rubric; an unknown one would be an error."""
    nested = scoring.inline_scores(_scores(spark, d).withColumn("reason", F.lit("stub")))
    return scoring.from_inline(nested, files.rubric(spark)).select("dialogue_id", "round", "dimension_id", F.col("score").cast("int").alias("score"))


_LEGACY = f"{_NUM.format(repr('legacy|') + ' || task_id')} % 10"


@query(f"WITH {_SCORES}, l AS (SELECT task_id, {_LEGACY} AS k FROM scores) SELECT CASE k WHEN 0 THEN 'x' || task_id ELSE task_id END AS task_id, CASE k WHEN 0 THEN 'unknown' WHEN 1 THEN 'duplicate' ELSE 'changed' END AS problem FROM l WHERE k < 3")
def migration_problems(spark: SparkSession, d: str) -> DataFrame:
    """Old scores of which some are of no task, come twice, or were given in another context."""
    kind = _hash6(F.concat(F.lit("legacy|"), "task_id")) % 10
    old = _scores(spark, d).select(F.when(kind == 0, F.concat(F.lit("x"), "task_id")).otherwise(F.col("task_id")).alias("task_id"), F.when(kind == 2, "other").otherwise(F.col("principle")).alias("principle"), "score", F.lit("stub").alias("reason"), kind.alias("k"))
    legacy = old.unionByName(old.where("k = 1")).drop("k")
    return scoring.migrate(legacy, _tasks(spark, d).select("task_id", "sample_id", "principle"), ["principle"])[1].distinct()


@query(
    f"""WITH t AS (SELECT group_id, id, max(name) AS name FROM topics GROUP BY ALL), c AS (SELECT DISTINCT group_id, CASE WHEN {_NUM.format(repr('pick|') + ' || id')} % 7 = 0 THEN id || 'x' ELSE id END AS id FROM t WHERE {_NUM.format(repr('pick|') + ' || id')} % 2 = 0)
    SELECT c.group_id AS service_name, c.id AS intent, t.name AS description FROM c LEFT JOIN t ON t.group_id = c.group_id AND t.id = c.id"""
)
def selected_intents(spark: SparkSession, d: str) -> DataFrame:
    """Chosen (service, intent) pairs looked up in nested services; unknown ones stay, without a description."""
    t = read_table(spark, d, "topics").groupBy("group_id", "id").agg(F.max("name").alias("name"))
    services = t.groupBy(F.col("group_id").alias("service_name")).agg(F.collect_list(F.struct(F.col("id").alias("name"), F.col("name").alias("description"))).alias("intents"))
    pick = _hash6(F.concat(F.lit("pick|"), "id"))
    chosen = t.where(pick % 2 == 0).select(F.col("group_id").alias("service_name"), F.when(pick % 7 == 0, F.concat("id", F.lit("x"))).otherwise(F.col("id")).alias("intent"))
    return lookups.select_intents(chosen, services)


@query("SELECT DISTINCT id, name, mode FROM topics")
def topics_together(spark: SparkSession, d: str) -> DataFrame:
    """The topics of each mode as tables of their own, put together with unique ids."""
    t = read_table(spark, d, "topics").select("id", "name", "mode").distinct()
    kinds = ["task", "topic_chat", "open_chat"]
    parts = [t.where(F.col("mode") == m) for m in kinds] + [t.where(~F.coalesce(F.col("mode").isin(*kinds), F.lit(False)))]
    return lookups.union_same_schema(parts, "id")


@query(f"WITH {_TURNS}, h AS (SELECT dialogue_id, content, instr(content, '{{') AS brace FROM turns WHERE role = 'system') SELECT dialogue_id, CASE WHEN brace > 0 THEN json_extract_string(substr(content, brace), '$.name') END AS name, CASE WHEN brace > 0 THEN json_extract_string(substr(content, brace), '$.habit') END AS habit FROM h")
def header_profiles(spark: SparkSession, d: str) -> DataFrame:
    """the profile inside each dialogue's header."""
    head = _turns(spark, d).where("role = 'system'").select("dialogue_id", X.embedded_json(F.col("content")).alias("v"))
    return head.select("dialogue_id", F.try_variant_get("v", "$.name", "string").alias("name"), F.try_variant_get("v", "$.habit", "string").alias("habit"))


@query(r"""SELECT DISTINCT id, regexp_replace(substr(profile, greatest(length(profile) // 2 - 24, 0) + 1, length(profile) // 2 + 24 - greatest(length(profile) // 2 - 24, 0)), '[^{}\[\]:,"\\\s]', 'x', 'g') AS shown FROM characters""")
def error_windows(spark: SparkSession, d: str) -> DataFrame:
    """what an error may show of a document around a place."""
    rows = read_table(spark, d, "characters").select("id", "profile").distinct()
    return rows.select("id", X.error_window(F.col("profile"), F.expr("cast(length(profile) div 2 as int)")).alias("shown")).distinct()


@query("SELECT DISTINCT dialogue_id, strftime(planned_at, '%Y-%m-%dT%H:%M:%S+00:00') AS planned FROM jobs WHERE planned_at IS NOT NULL")
def iso_times(spark: SparkSession, d: str) -> DataFrame:
    """F18."""
    return read_table(spark, d, "jobs").where("planned_at IS NOT NULL").select("dialogue_id", transcript.iso_time(F.col("planned_at")).alias("planned")).distinct()


@query("SELECT DISTINCT dialogue_id, CASE WHEN status = 'incompatible' AND phase = 'scene' THEN 'pending' ELSE status END AS status, phase FROM jobs")
def jobs_begun_anew(spark: SparkSession, d: str) -> DataFrame:
    """T16."""
    return transcript.reset_rejected(read_table(spark, d, "jobs").select("dialogue_id", "status", "phase").distinct())


@query("SELECT n, key, CASE WHEN key = 'sharp' THEN n ELSE 0 END AS seats FROM range(1, 101) x(n) CROSS JOIN (VALUES ('neutral'), ('gentle'), ('sharp')) t(key)")
def fixed_choice(spark: SparkSession, d: str) -> DataFrame:
    """A fixed tone takes all seats, at every count."""
    rows = quota.weights_table(spark, {"tone": quota.override(_W["tone"], "sharp")}).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(100)).cast("array<bigint>")))
    return quota.largest_remainder(rows, ["axis", "n"]).select("n", "key", "seats")


@query(f"WITH {_SCORES}, {_META} SELECT DISTINCT task_id FROM graded JOIN meta USING (dialogue_id) WHERE mode = 'task'")
def tasks_of_a_mode(spark: SparkSession, d: str) -> DataFrame:
    """The tasks of one mode only."""
    return _tasks(spark, d).join(checks.in_modes(_meta(spark, d), ["task"]), "dialogue_id").select("task_id")


@query("SELECT id, rule FROM (SELECT id, unnest(list_filter([CASE WHEN speech_style IS NULL THEN 'speech_style' END, CASE WHEN source_row_index IS NULL THEN 'source_row_index' END], lambda x: x IS NOT NULL)) AS rule FROM (SELECT DISTINCT id, speech_style, source_row_index FROM users))")
def catalogue_violations(spark: SparkSession, d: str) -> DataFrame:
    """Rules as columns, violations as rows."""
    rows = read_table(spark, d, "users").select("id", "speech_style", "source_row_index").distinct()
    return checks.violations(rows, "id", {"speech_style": checks.nonblank(F.col("speech_style")), "source_row_index": F.col("source_row_index").isNotNull()})


@query("SELECT id, string_agg('<' || line || '>', chr(10) ORDER BY k) AS translated FROM (SELECT id, unnest(range(len(ls))) AS k, unnest(ls) AS line FROM (SELECT DISTINCT id, string_split(persona, chr(10)) AS ls FROM users)) GROUP BY id")
def translated_personas(spark: SparkSession, d: str) -> DataFrame:
    """Every line looked up, the lines put together in order."""
    rows = read_table(spark, d, "users").select("id", "persona").distinct()
    lines = rows.select(F.explode(X.split_lines(F.col("persona"))).alias("source")).distinct()
    whole, _ = lookups.translate_lines(rows, lines.withColumn("target", F.concat(F.lit("<"), "source", F.lit(">"))), "id")
    return whole


@query("SELECT mode, count(DISTINCT id) AS topics, count(DISTINCT group_id) AS groups FROM topics GROUP BY ROLLUP (mode)")
def topic_rollup(spark: SparkSession, d: str) -> DataFrame:
    """A13, G9."""
    return read_table(spark, d, "topics").rollup("mode").agg(F.countDistinct("id").alias("topics"), F.countDistinct("group_id").alias("groups"))


@query(
    "WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders) SELECT o_custkey, o_orderkey FROM o WHERE k = 1"
)
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    """G12, W5 over the order table: the last row of each key, by partial aggregation."""
    o = read_table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", -F.col("o_orderkey"))).alias("o_orderkey"))


@query(
    f"""WITH {_SCORES}, {_META}, l AS (SELECT *, (i + 1) || '. ' || CASE WHEN role = 'user' THEN '用户' ELSE '角色' END || '：' || coalesce(content, '') AS line FROM pub),
    h AS (SELECT dialogue_id, CAST(i // 2 + 1 AS INTEGER) AS round, string_agg(line, chr(10)) OVER (PARTITION BY dialogue_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history, content AS reply, i FROM l)
    SELECT g.task_id, md5(g.principle || '|' || coalesce(m.mode, '') || '|' || coalesce(m.character_name, '') || '|' || h.history || '|' || coalesce(h.reply, '')) AS prompt FROM graded g JOIN h ON h.dialogue_id = g.dialogue_id AND h.round = g.round AND h.i % 2 = 1 JOIN meta m ON m.dialogue_id = g.dialogue_id"""
)
def judge_prompts(spark: SparkSession, d: str) -> DataFrame:
    """The prompt of every task, as its digest."""
    samples = transcript.reply_samples(_turns(spark, d)).withColumn("history", transcript.history_text(F.col("history"))).join(_meta(spark, d), "dialogue_id")
    tasks = scoring.task_grid(samples, files.rubric(spark)).select("task_id", "principle", "mode", "character_name", "history", "model_response")
    prompts = transcript.judge_prompts(tasks, "$principle|$mode|$character_name|$history|$model_response")
    return prompts.select("task_id", F.md5("prompt").alias("prompt"))


@query("SELECT id, tone, tone || '_preset' AS preset_id FROM (SELECT id, list_extract(['neutral', 'gentle', 'sharp'], 1 + ('0x' || substr(md5('user_behaviors:7|' || id), 1, 13))::BIGINT % 3) AS tone FROM (SELECT DISTINCT dialogue_id AS id FROM jobs))")
def tone_presets(spark: SparkSession, d: str) -> DataFrame:
    """J7, A8."""
    presets = spark.createDataFrame([(f"{t}_preset", t) for t in ("neutral", "gentle", "sharp")], "id string, tone string")
    return quota.with_presets(preset_choice(spark, d), presets).select("id", "tone", "preset_id")


@query(
    f"""WITH {_PUBLIC}, n AS (SELECT dialogue_id, count(*) AS c FROM pub GROUP BY dialogue_id)
    SELECT dialogue_id, c // 2 AS rounds, CASE WHEN c // 2 >= 4 THEN 'completed' ELSE 'running' END AS status, CASE WHEN c // 2 >= 4 THEN 'done' ELSE 'user' END AS phase FROM n WHERE c % 2 = 0"""
)
def closed_rounds(spark: SparkSession, d: str) -> DataFrame:
    """With four rounds at most."""
    rows = transcript.public_turns(_turns(spark, d)).groupBy("dialogue_id").agg(F.collect_list("i").alias("messages"))
    return transcript.close_round(rows.withColumn("goal", F.lit(False)), 4).select("dialogue_id", "rounds", "status", "phase")


@query(
    f"""WITH {_TURNS}, n AS (SELECT dialogue_id, count(*) AS n FROM turns GROUP BY dialogue_id),
    k AS (SELECT t.*, row_number() OVER (PARTITION BY t.dialogue_id ORDER BY pos) AS k, n FROM turns t JOIN n USING (dialogue_id)),
    m AS (SELECT dialogue_id, string_agg(role || ':' || coalesce(content, ''), chr(10) ORDER BY pos) AS messages FROM k WHERE k <= CASE WHEN n % 2 = 0 THEN n - 1 ELSE n END GROUP BY dialogue_id),
    s AS (SELECT dialogue_id, min(scene.relationship) AS relationship, min(user_goal) AS user_goal FROM transcripts GROUP BY dialogue_id)
    SELECT m.*, relationship, user_goal FROM m JOIN s USING (dialogue_id)"""
)
def review_transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Header and complete pairs with the scene."""
    scenes = read_table(spark, d, "transcripts").groupBy("dialogue_id").agg(F.min("scene.relationship").alias("relationship"), F.min("user_goal").alias("user_goal"))
    rows = transcript.review_transcript(_turns(spark, d), scenes)
    line = lambda x: F.concat(x["role"], F.lit(":"), F.coalesce(x["content"], F.lit("")))
    return rows.withColumn("messages", F.array_join(F.transform("messages", line), "\n"))


@query("SELECT event_type, count(*) AS attempts, count(*) FILTER (event_type <> 'error') AS succeeded, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS tokens FROM events GROUP BY event_type")
def attempt_totals(spark: SparkSession, d: str) -> DataFrame:
    """Counters out of JSON maps."""
    rows = read_table(spark, d, "events").select("event_type", (F.col("event_type") != "error").alias("ok"), F.from_json("props", "map<string,bigint>").alias("usage"))
    out = scoring.attempt_totals(rows, ["event_type"])
    return out.select("event_type", "attempts", "succeeded", F.try_element_at("totals", F.lit("k")).alias("tokens"))


@query(
    f"""WITH {_TURNS}, j AS (SELECT dialogue_id, min(status) AS status, min(phase) AS phase FROM jobs GROUP BY dialogue_id), t AS (SELECT dialogue_id, min(character_name) AS character_name FROM transcripts GROUP BY dialogue_id),
    l AS (SELECT dialogue_id, count(*) AS logged FROM turns WHERE role = 'system' GROUP BY dialogue_id) SELECT j.dialogue_id, status, phase, character_name, logged FROM j JOIN t USING (dialogue_id) LEFT JOIN l USING (dialogue_id)"""
)
def restored_jobs(spark: SparkSession, d: str) -> DataFrame:
    """State with its transcript, and its log where there is one."""
    state = read_table(spark, d, "jobs").groupBy("dialogue_id").agg(F.min("status").alias("status"), F.min("phase").alias("phase"))
    told = read_table(spark, d, "transcripts").groupBy("dialogue_id").agg(F.min("character_name").alias("character_name"))
    logs = _turns(spark, d).where("role = 'system'").groupBy("dialogue_id").agg(F.count("*").alias("logged"))
    return lookups.restore(state, told, logs)


@query("SELECT user_id, event_type, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY user_id, event_type HAVING count(*) > 1")
def repeated_events(spark: SparkSession, d: str) -> DataFrame:
    """P6 on a compound key."""
    rows = read_table(spark, d, "events")
    return checks.repeated_keys(rows, "user_id", "event_type").join(rows.groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_id")), ["user_id", "event_type"])


@query("SELECT l_returnflag, l_linestatus, sum(n)::BIGINT AS n, round_even(sum(s) / sum(n), 4) AS mean_quantity, round_even(avg(s / n), 4) AS macro_quantity FROM (SELECT l_returnflag, l_linestatus, l_suppkey, count(*) AS n, sum(l_quantity) AS s FROM lineitem GROUP BY ALL) GROUP BY ALL")
def macro_over_lineitem(spark: SparkSession, d: str) -> DataFrame:
    """G2 over the largest star table: micro and macro means in one shuffle of partial sums."""
    per = read_table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("s"))
    out = per.groupBy("l_returnflag", "l_linestatus").agg(F.sum("n").alias("n"), F.bround(F.sum("s") / F.sum("n"), 4).alias("mean_quantity"), F.bround(F.avg(F.col("s") / F.col("n")), 4).alias("macro_quantity"))
    return out
