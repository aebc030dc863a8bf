"""The queries of the eight problems, over the test tables, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.labels import id_key, label_key, role_key
from dialoom.session import Scratch, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _resolved_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dialogue_id, status, character, person, topic): ids of ``job`` as catalogue rows.

    A user with a source row is the person of that row, any other one the person of its id.
    """
    jobs = read_table(spark, sf_dir, "jobs").select(
        "dialogue_id", "status", id_key(F.col("job.character.id")).alias("ck"), id_key(F.col("job.user.id")).alias("uk"), id_key(F.col("job.topic.id")).alias("tk")
    ).distinct()
    chars = read_table(spark, sf_dir, "characters")
    names = chars.select("id", "id").toDF("ck", "character").union(chars.select("former_id", "id")).where("ck IS NOT NULL")
    names = names.select(id_key(F.col("ck")).alias("ck"), "character").groupBy("ck").agg(F.min("character").alias("character"))
    users = read_table(spark, sf_dir, "users").select(
        id_key(F.col("id")).alias("uk"),
        F.coalesce(F.concat(F.lit("row "), F.col("source_row_index").cast("string")), F.concat(F.lit("id "), F.col("id"))).alias("person"),
    ).groupBy("uk").agg(F.max("person").alias("person"))
    topics = read_table(spark, sf_dir, "topics").select(id_key(F.col("id")).alias("tk"), F.col("id").alias("topic")).groupBy("tk").agg(F.min("topic").alias("topic"))
    return jobs.join(names, "ck", "left").join(users, "uk", "left").join(topics, "tk", "left").select("dialogue_id", "status", "character", "person", "topic")


def _split_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dialogue_id, split, group_id, status): every job with the split of its group."""
    from dialoom.llm.splits import linked_groups, split_groups

    jobs = Scratch(spark, "jobs").table(_resolved_jobs(spark, sf_dir))
    once = jobs.groupBy("dialogue_id").agg(F.min("status").alias("status"), F.min("character").alias("character"))
    grouped = linked_groups(jobs, "dialogue_id", ["character", "person", "topic"]).join(once, "dialogue_id")
    grouped = Scratch(spark, "grouped").table(grouped)
    split = split_groups(grouped, "dialogue_id", label="status")
    ids = grouped.groupBy("component").agg(F.min("character").alias("group_id"))
    return split.join(ids, "component").select("dialogue_id", "component", "split", "group_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_jobs(spark, sf_dir).select("dialogue_id", "group_id")


def p1_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_jobs(spark, sf_dir).select("dialogue_id", "split")


def p1_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the splits: one row per split; sizes and labels within 2 % or 3 jobs, no group in two."""
    rows = _split_jobs(spark, sf_dir)
    status = read_table(spark, sf_dir, "jobs").groupBy("dialogue_id").agg(F.min("status").alias("status"))
    rows = Scratch(spark, "contract").table(rows.join(status, "dialogue_id"))
    share = F.when(F.col("split") == "train", 0.8).otherwise(0.1)
    torn = rows.groupBy("group_id").agg(F.count_distinct("split").alias("n")).where("n > 1").agg(F.count("*").alias("groups_torn"))
    whole = rows.groupBy("split").agg(F.count("*").alias("n")).join(rows.agg(F.count("*").alias("jobs"))).select("split", "jobs", (F.abs(F.col("n") - share * F.col("jobs")) <= F.greatest(F.lit(3.0), 0.02 * F.col("jobs"))).alias("size_kept"))
    cell = rows.groupBy("split", "status").agg(F.count("*").alias("n")).join(rows.groupBy("status").agg(F.count("*").alias("all")), "status")
    labels = cell.groupBy("split").agg(F.max(F.abs(F.col("n") - share * F.col("all")) / F.greatest(F.lit(150.0), F.col("all"))).alias("off")).select("split", (F.col("off") <= 0.02).alias("labels_kept"))
    return whole.join(labels, "split").join(torn)


def _dialogue_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, place, part): scene first, then user and assistant messages, of dialogues in transcripts."""
    scene = F.concat_ws("\n", F.col("scene.background"), F.col("scene.trigger"), F.col("scene.facts"))
    heads = read_table(spark, sf_dir, "transcripts").select(F.col("dialogue_id").alias("id"), F.lit(-1).alias("place"), scene.alias("part"))
    said = _utterances(spark, sf_dir).select(F.col("dialogue_id").alias("id"), F.col("pos").alias("place"), F.col("content").alias("part"))
    return heads.unionByName(said)


def _near_dialogues(spark: SparkSession, sf_dir: str):
    from dialoom.llm.neardup import NearDuplicates

    return NearDuplicates(_dialogue_parts(spark, sf_dir), k=5, threshold=0.6)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near_dialogues(spark, sf_dir).all_pairs().toDF("dialogue_id_a", "dialogue_id_b")


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near_dialogues(spark, sf_dir).groups().withColumnRenamed("id", "dialogue_id")


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Distinct dialogues with canonical labels, and the targets."""
    targets = read_table(spark, sf_dir, "sampling_targets")
    rows = read_table(spark, sf_dir, "transcripts").select(
        "dialogue_id", label_key(F.col("conversation_start.mode")).alias("mk"), label_key(F.col("user_behavior.tone")).alias("tk")
    ).distinct()
    known = targets.select("mode", "tone", label_key(F.col("mode")).alias("mk"), label_key(F.col("tone")).alias("tk")).distinct()
    return rows.join(known, ["mk", "tk"]).select("dialogue_id", "mode", "tone"), targets


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.quota_sample import shortfalls

    return shortfalls(*_labelled(spark, sf_dir), "dialogue_id", ["mode", "tone"]).select("plan_id", "mode", "tone")


def p4_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.quota_sample import draw

    return draw(*_labelled(spark, sf_dir), "dialogue_id", ["mode", "tone"]).select("plan_id", "dialogue_id", "mode", "tone")


def p4_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows drawn of each target, counted in the sample, and the distinct ids among them."""
    sample = p4_sample(spark, sf_dir).groupBy("plan_id", "mode", "tone").agg(F.count("*").alias("seats"), F.count_distinct("dialogue_id").alias("ids"))
    return sample.orderBy("plan_id", "mode", "tone")


def _utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User and assistant messages, as written; redelivered rows are still there."""
    return read_table(spark, sf_dir, "messages").where(role_key(F.col("role")).isin("user", "assistant"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.replies import defective_replies

    return defective_replies(read_table(spark, sf_dir, "messages"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.repetition import prevailing

    # copies of a row get equal results, so only what is found needs to be made distinct
    rows = _utterances(spark, sf_dir).select("dialogue_id", "pos", "content")
    return prevailing(rows).select("dialogue_id", "pos").distinct()


def p5_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.repetition import repeated_share

    rows = repeated_share(_utterances(spark, sf_dir).select("dialogue_id", "pos", "content"))
    return rows.select("dialogue_id", "pos", "n_letters", "repeated_share").distinct()


def p6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pack_sizes"))


def p6_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the packing, one row per container size: every document once, nothing too full, nothing cut that fits, no gap."""
    sizes = read_table(spark, sf_dir, "pack_sizes").select("pack_id", F.col("capacity_tokens").alias("cap"))
    rows = Scratch(spark, "contract").table(p6_pack(spark, sf_dir).join(F.broadcast(sizes) if sizes.count() < 1000 else sizes, "pack_id"))
    by_doc = rows.groupBy("pack_id", "doc_id").agg(F.count("*").alias("k"), F.sum("n_tokens").alias("n"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"), F.max("cap").alias("cap"))
    bad = lambda c: F.sum(F.expr(c).cast("bigint"))
    docs = by_doc.groupBy("pack_id").agg(F.count("*").alias("docs"), bad("k > 1 AND n <= cap").alias("cut_without_need"), bad("n <> end").alias("with_gaps"))
    filled = rows.groupBy("pack_id", "container").agg(F.sum("n_tokens").alias("n"), F.max("cap").alias("cap"), F.count("*").alias("k"), F.max("place").alias("last"), F.count_distinct("place").alias("places"))
    fill = filled.groupBy("pack_id").agg(bad("n > cap").alias("too_full"), bad("k <> last OR k <> places").alias("places_wrong"))
    return docs.join(fill, "pack_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_overlaps(spark, sf_dir).where("exact_letters >= min_letters").select("doc_id", "item_id")


def p7_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.leakage import leaked_items

    return leaked_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.uniform import look_alike_pairs

    return look_alike_pairs(read_table(spark, sf_dir, "documents"))


def p8_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.uniform import look_alike_groups

    return look_alike_groups(read_table(spark, sf_dir, "documents"))


def p8_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.llm.uniform import uniform_text

    return uniform_text(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "uniform_text")


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    """SQL of what SQL can say over whole tables; it looks at every window, pair or path."""
    full, half = "".join(chr(c) for c in range(0xFF01, 0xFF5F)).replace("'", "''"), "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
    wide = lambda x: f"translate({x}, '{full}', '{half}')"
    label = lambda x: f"lower(regexp_replace({wide(x)}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"
    letters = lambda x: f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"

    def key(x: str) -> str:
        plain = f"lower(regexp_replace({wide(x)}, '[^\\p{{L}}\\p{{N}}/.]+', '', 'g'))"
        stem = f"replace(regexp_replace(regexp_replace({plain}, '^.*/', ''), '\\.json$', ''), '.', '')"
        return f"regexp_replace({stem}, '(^|[^0-9])0+([0-9])', '\\1\\2', 'g')"

    said = f"""said AS (SELECT DISTINCT dialogue_id, pos, content FROM messages WHERE {label('role')} IN ('user', 'assistant', 'character'))"""
    share = f"""WITH {said}, m AS (SELECT dialogue_id, pos, {letters("coalesce(content, '')")} AS l FROM said),
        g AS (SELECT dialogue_id, pos, i, substr(l, i, 10) AS gram FROM (SELECT *, unnest(range(1, length(l) - 8)) AS i FROM m WHERE length(l) >= 10)),
        r AS (SELECT dialogue_id, pos, i FROM (SELECT *, row_number() OVER (PARTITION BY dialogue_id, pos, gram ORDER BY i) AS k FROM g) WHERE k > 1),
        c AS (SELECT dialogue_id, pos, count(DISTINCT i + k) AS n FROM r CROSS JOIN range(10) x(k) GROUP BY dialogue_id, pos),
        s AS (SELECT m.dialogue_id, m.pos, CAST(length(l) AS INTEGER) AS n_letters, CASE WHEN length(l) > 0 THEN round(coalesce(n, 0) / length(l), 6) ELSE 0 END AS repeated_share FROM m LEFT JOIN c USING (dialogue_id, pos))"""
    jobs = f"""j AS (SELECT dialogue_id, min({key('job.character.id')}) AS ck, min({key('job.user.id')}) AS uk, min({key('job.topic.id')}) AS tk FROM jobs GROUP BY dialogue_id),
        cn AS (SELECT k, min(id) AS id FROM (SELECT {key('id')} AS k, id FROM characters UNION ALL SELECT {key('former_id')}, id FROM characters) WHERE k IS NOT NULL GROUP BY k),
        un AS (SELECT {key('id')} AS k, max(coalesce('row ' || source_row_index, 'id ' || id)) AS id FROM users GROUP BY 1),
        q AS (SELECT dialogue_id, cn.id AS c, 'u' || un.id AS u, 't' || tk AS t FROM j LEFT JOIN cn ON cn.k = ck LEFT JOIN un ON un.k = uk),
        e AS (SELECT DISTINCT 'c' || c AS a, u AS b FROM q WHERE u IS NOT NULL UNION SELECT 'c' || c, t FROM q WHERE t IS NOT NULL),
        b AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT 'c' || c, 'c' || c FROM q)"""
    labelled = f"""r AS (SELECT DISTINCT dialogue_id, {label('conversation_start.mode')} AS mk, {label('user_behavior.tone')} AS tk FROM transcripts),
        n AS (SELECT mk, tk, count(DISTINCT dialogue_id) AS available FROM r GROUP BY ALL)"""
    near = f"""WITH {said}, scene AS (SELECT dialogue_id, min(coalesce(scene.background, '') || coalesce(scene.trigger, '') || coalesce(array_to_string(scene.facts, ''), '')) AS s FROM transcripts GROUP BY dialogue_id),
        body AS (SELECT dialogue_id, string_agg(content, '' ORDER BY pos) AS c FROM said GROUP BY dialogue_id),
        d AS (SELECT dialogue_id, {letters("s || coalesce(c, '')")} AS l FROM scene LEFT JOIN body USING (dialogue_id)),
        g AS (SELECT DISTINCT dialogue_id, substr(l, i, 5) AS x FROM (SELECT *, unnest(range(1, length(l) - 3)) AS i FROM d WHERE length(l) >= 5)),
        n AS (SELECT dialogue_id, count(*) AS n FROM g GROUP BY dialogue_id),
        o AS (SELECT a.dialogue_id AS a, b.dialogue_id AS b, count(*) AS c FROM g a JOIN g b ON a.x = b.x AND a.dialogue_id < b.dialogue_id GROUP BY ALL)
        SELECT a AS dialogue_id_a, b AS dialogue_id_b FROM o JOIN n p ON p.dialogue_id = a JOIN n q ON q.dialogue_id = b WHERE c >= 0.6 * (p.n + q.n - c)"""
    # the same reading forms written down on their own, for the characters the tables hold
    shapes = (
        "АВЕКМНОРСТУХІЅЈаеорсухіѕј" + "ΑΒΕΖΗΙΚΜΝΟΡΤΧΥο" + "ёЁѐЀїЇ" + "όΌΆΈΊ" + "‐‑" + "⼀⼆⼈⼊⼋⼒⼗⼝⼟⼠⼤⼥⼦⼩⼭⼯⼰⼱⼲⼸⼼⼿⽀⽂⽄⽅⽇⽉⽊⽋⽌⽐⽑⽒⽔⽕⽗⽚⽛⽜⽝⽟⽠⽡⽢⽣⽤⽥⽩⽪⽫⽬⽭⽮⽯⽰⽲⽳⽴⽵⽶⽷⽸⽺⽻⽼⽽⽿⾁⾃⾄⾅⾆⾈⾊⾍⾏⾐⾓⾔⾕⾖⾛⾜⾝⾞⾟⾢⾥⾦⾨⾬⾮⾯⾳⾶⾷⾸⾹⾺⾻⾼",
        "ABEKMHOPCTYXISJaeopcyxisj" + "ABEZHIKMNOPTXYo" + "ëËèÈïÏ" + "óÓÁÉÍ" + "--" + "一二人入八力十口土士大女子小山工己巾干弓心手支文斗方日月木欠止比毛氏水火父片牙牛犬玉瓜瓦甘生用田白皮皿目矛矢石示禾穴立竹米糸缶羊羽老而耳肉自至臼舌舟色虫行衣角言谷豆走足身車辛邑里金門雨非面音飛食首香馬骨高",
    )
    kana_half = "｡｢｣､･ｦｧｨｩｪｫｬｭｮｯｰｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜﾝﾞﾟ"
    kana_full = "。「」、・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン\u3099\u309a"
    blanks = "\u00a0\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\t"
    unseen = "[\u00ad\u034f\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff\ufe00-\ufe0f]"

    def reads(x: str) -> str:
        plain = f"translate({wide(f'translate({x}, {chr(39)}{blanks}{chr(39)}, {chr(39)}{len(blanks) * chr(32)}{chr(39)})')}, '{kana_half}', '{kana_full}')"
        shaped = f"translate(nfc_normalize(translate(nfc_normalize(regexp_replace({plain}, '{unseen}', '', 'g')), '{shapes[0]}', '{shapes[1]}')), '{shapes[0]}', '{shapes[1]}')"
        for a, b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
            shaped = f"replace({shaped}, '{a}', '{b}')"
        return f"translate(replace(replace({shaped}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), 'ニロハカタエトヘペベ', '二口八力夕工卜へぺべ')"

    doc = f"u AS (SELECT doc_id, text, {reads('text')} AS t FROM documents)"
    item = f"v AS (SELECT item_id, lang, {reads('text')} AS t FROM eval_items)"
    # katakana again: in a stretch with other katakana, but for those next to an ideograph outside
    pieces = "regexp_extract_all(t, '[\\p{Katakana}ー二口八力夕工卜]+|[^\\p{Katakana}ー二口八力夕工卜]+')"
    back = "translate(y, '二口八力夕工卜', 'ニロハカタエト')"
    left = "CASE WHEN i > 1 AND regexp_matches(l[i - 1], '\\p{Han}$') THEN regexp_extract(x, '^[二口八力夕工卜]*') ELSE '' END"
    right = "CASE WHEN i < len(l) AND regexp_matches(l[i + 1], '^\\p{Han}') THEN regexp_extract(x, '[二口八力夕工卜]*$') ELSE '' END"
    core = back.replace("y", f"substr(x, length({left}) + 1, length(x) - length({left}) - length({right}))")
    word = f"list_transform(l, lambda x, i: CASE WHEN regexp_matches(x, '[\\p{{Katakana}}]') THEN {left} || {core} || {right} ELSE x END)"
    he = "array_to_string(w, '')"
    for a, b in ("へヘ", "ぺペ", "べベ"):
        he = f"regexp_replace({he}, '(^|[^\\p{{Han}}\\p{{Katakana}}ー]){a}([\\p{{Katakana}}ー])', '\\1{b}\\2', 'g')"
    leak = f"""WITH {doc}, {item}, dl AS (SELECT doc_id, {letters('t')} AS l FROM u WHERE t IS NOT NULL),
        il AS (SELECT item_id, {letters('t')} AS l, CASE lang WHEN 'zh' THEN 30 ELSE 60 END AS n FROM v WHERE t IS NOT NULL),
        iw AS (SELECT DISTINCT item_id, n, substr(l, i, n) AS w FROM (SELECT *, unnest(range(1, length(l) - n + 2)) AS i FROM il WHERE length(l) >= n)),
        dw AS (SELECT DISTINCT doc_id, n, substr(l, i, n) AS w FROM (SELECT *, unnest(range(1, length(l) - n + 2)) AS i FROM (SELECT * FROM dl CROSS JOIN (VALUES (30), (60)) x(n)) WHERE length(l) >= n))
        SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (n, w)"""
    return {
        "p1_found": f"""WITH RECURSIVE {jobs}, reach(x, y) AS (SELECT a, b FROM b UNION SELECT r.x, b.b FROM reach r JOIN b ON r.y = b.a),
            g AS (SELECT x, min(substr(y, 2)) FILTER (y LIKE 'c%') AS group_id FROM reach GROUP BY x) SELECT dialogue_id, group_id FROM q JOIN g ON g.x = 'c' || c""",
        "p3_found": near,
        "p3_groups": f"""WITH RECURSIVE pr AS ({near}), b AS (SELECT dialogue_id_a AS x, dialogue_id_b AS y FROM pr UNION SELECT dialogue_id_b, dialogue_id_a FROM pr), reach(x, y) AS (SELECT x, y FROM b UNION SELECT r.x, b.y FROM reach r JOIN b ON r.y = b.x)
            SELECT x AS dialogue_id, least(x, min(y)) AS group_id, count(DISTINCT y) AS group_size FROM reach GROUP BY x""",
        "p4_found": f"""WITH {labelled} SELECT plan_id, mode, tone FROM sampling_targets LEFT JOIN n ON mk = {label('mode')} AND tk = {label('tone')}
            WHERE coalesce(available, 0) < greatest(share * sample_size, min_rows)""",
        # the three splits with what they keep; the counts come from the table
        "p1_contract": """SELECT unnest(['train', 'validation', 'test']) AS split, count(DISTINCT dialogue_id) AS jobs, true AS size_kept, true AS labels_kept, CAST(0 AS BIGINT) AS groups_torn FROM jobs""",
        # every row of every category with its priority; a plan takes floors first, then the smallest
        "p4_seats": f"""WITH {labelled}, a AS (SELECT plan_id, mode, tone, CAST(share AS DOUBLE) AS share, sample_size, min_rows, coalesce(available, 0) AS available FROM sampling_targets LEFT JOIN n ON mk = {label('mode')} AND tk = {label('tone')}),
            p AS (SELECT *, unnest(range(1, available + 1)) AS r FROM a), o AS (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY r > min_rows, (r - 0.5) / share, mode, tone) AS place FROM p WHERE share > 0 OR r <= min_rows)
            SELECT plan_id, mode, tone, count(*) AS seats, count(*) AS ids FROM o WHERE place <= sample_size GROUP BY ALL""",
        "p5_found": f"{share} SELECT dialogue_id, pos FROM s WHERE n_letters >= 40 AND repeated_share >= 0.5",
        "p5_share": f"{share} SELECT * FROM s",
        "p6_contract": """SELECT pack_id, (SELECT count(DISTINCT doc_id) FROM documents) AS docs, CAST(0 AS BIGINT) AS cut_without_need, CAST(0 AS BIGINT) AS with_gaps, CAST(0 AS BIGINT) AS too_full, CAST(0 AS BIGINT) AS places_wrong FROM pack_sizes""",
        "p7_found": leak,
        "p8_found": f"""WITH {doc} SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM u a JOIN u b ON a.t = b.t AND a.doc_id < b.doc_id AND a.text <> b.text WHERE regexp_matches(a.t, '\\S')""",
        "p8_groups": f"""WITH {doc}, k AS (SELECT t, min(doc_id) AS group_id, count(DISTINCT text) AS variants, count(*) AS n FROM u WHERE regexp_matches(t, '\\S') GROUP BY t HAVING count(DISTINCT text) > 1),
            s AS (SELECT text, count(*) AS same FROM u GROUP BY text) SELECT doc_id, group_id, variants, n - same AS n_links FROM u JOIN k USING (t) JOIN s USING (text)""",
        "p8_uniform": f"""WITH {doc}, p AS (SELECT doc_id, t, {pieces} AS l FROM u), q AS (SELECT doc_id, t, {word} AS w FROM p)
            SELECT doc_id, CASE WHEN regexp_matches(t, '[\\p{{Katakana}}]') THEN {he} ELSE t END AS uniform_text FROM q""",
    }
