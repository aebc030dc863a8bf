import json
import random

import pytest
from pyspark.sql import functions as F

from dialoom.functions import text as X
from dialoom.functions.json_text import tolerant_object
from dialoom.functions.labels import id_key, label_key
from dialoom.operators import backend, checks, dedup, lookups, runner, scoring, transcript
from dialoom.operators.components import connected_components
from dialoom.plans.queries import queries
from dialoom.session import exclusive
from dialoom.sources import files


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


def test_text_functions(spark):
    assert one(spark, "  a 　b\n c ", X.squeeze) == "a b c"
    assert one(spark, "名（旧）; x", X.display_name) == "名"
    assert one(spark, "I can't. I've  cannot!", X.normalize_fact) == "i can not i have can not"
    assert one(spark, "friends do not call my by name", X.normalize_fact) == "friends do not call me by name"
    assert one(spark, "...", X.normalize_fact) == ""
    assert one(spark, "a\r\nb c\u000bd\n", X.split_lines) == "a\r\nb c\u000bd\n".splitlines()
    assert one(spark, None, X.normalize_fact) is None
    assert one(spark, "v $y", lambda c: X.fill_template("$$ $x ${x}", {"x": c})) == "$ v $y v $y"
    assert one(spark, "dialogue_00012", X.id_number) == 12 and one(spark, "dialogue_1.json", X.id_number) is None
    assert one(spark, 'Profile {"a": 1}', lambda c: F.to_json(X.embedded_json(c))) == '{"a":1}'
    assert "secret" not in one(spark, '{"k": secret, 1}', lambda c: X.error_window(c, F.lit(6)))


def test_label_and_id_keys(spark):
    for x in ("topic_chat", "Topic Chat", "topicChat", "topic＿chat", "ＴＯＰＩＣ-chat​", "topic chat\xa0"):
        assert one(spark, x, label_key) == "topicchat"
    for x in ("SPC_0000185", "SPC_185", "spc-0000185", "ＳＰＣ_００００１８５", " SPC0000185​"):
        assert one(spark, x, id_key) == "spc185"
    assert one(spark, "some/folder/a_b_9_profile.json", id_key) == one(spark, "A-B-9-PROFILE", id_key) == "ab9profile"
    assert one(spark, "", label_key) == "" and one(spark, None, label_key) is None


@pytest.mark.parametrize(
    "text,want",
    [('{"a": 1}', {"a": 1}), ("﻿{}", {}), ('```\n{"a": 1}\n```', {"a": 1}), ('```JSON {"a": 1}```', {"a": 1}), ('so: {"a": {"b": [1]}} end', {"a": {"b": [1]}}), ("[1]", None), ("3", None), ('x [1] {"a": 1}', None), ('{"a": 1} {"b": 2}', None), ('x {"a": 1} ]', None), ("", None), (None, None), ("{", None)],
)
def test_tolerant_object(text, want):
    assert tolerant_object(text) == want


def test_components_on_random_graphs(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(220)]
    edges += [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(200)] + [("hub", f"h{i}") for i in range(100)] + [(None, "z"), ("self", "self")]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    groups: dict = {}
    for x in list(parent):
        groups.setdefault(root(x), []).append(x)
    assert got == {x: min(v) for v in groups.values() for x in v}
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


def brute_groups(facts):
    ids = sorted(facts)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (len(facts[a] & facts[b]) >= 3 or facts[a] <= facts[b] or facts[b] <= facts[a]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}


def test_profile_groups_equal_pairs(spark):
    rng = random.Random(11)
    for trial in range(3):
        facts = {f"p{i:02d}": frozenset(rng.sample([f"f{j}" for j in range(14)], rng.choice([1, 2, 3, 4, 5]))) for i in range(30)}
        rows = [(i, "\n".join(sorted(fs))) for i, fs in facts.items()]
        df = spark.createDataFrame(rows + rows[:3], "id string, persona string")
        f = dedup.facts(df, "id", F.col("persona"))
        assert {r.id: r.component for r in dedup.profile_groups(f).collect()} == brute_groups(facts)
        pairs = {(r.a, r.b) for r in dedup.overlap_pairs(f).collect()}
        rep = {r.id: r.rep for r in dedup.fact_classes(f).collect()}
        assert rep == {i: min(j for j in facts if facts[j] == facts[i]) for i in facts}
        assert pairs == {(a, b) for a in set(rep.values()) for b in set(rep.values()) if a < b and (len(facts[a] & facts[b]) >= 3 or facts[a] <= facts[b] or facts[b] <= facts[a])}


def test_long_and_crowded_profiles_are_grouped_without_their_pairs(spark):
    rng = random.Random(2)
    crowd = {f"c{i:03d}": {"hot1", "hot2", "hot3", f"own{i}", f"other{i}"} for i in range(120)}
    apart = {f"s{i:03d}": {"hot1", "hot2", f"x{i}", f"y{i}"} for i in range(60)}
    long = {f"l{k}": {f"w{j}" for j in rng.sample(range(400), 90)} | {"hot1"} for k in range(6)}
    facts = {i: frozenset(fs) for i, fs in (crowd | apart | long).items()}
    df = spark.createDataFrame([(i, "\n".join(sorted(fs))) for i, fs in facts.items()], "id string, persona string")
    f = dedup.facts(df, "id", F.col("persona"))
    assert {r.id: r.component for r in dedup.profile_groups(f).collect()} == brute_groups(facts)
    assert dedup.overlap_edges(f).count() < 2000


def test_batch_and_ordered_dedup_differ(spark):
    # the third is alike only to a variant that the second replaced
    rows = [(0, "a\nb\nc\nd"), (1, "a\nb\nc\nx\ny"), (2, "x\ny\nd\nz")]
    df = spark.createDataFrame([(i, f"u{i}", t) for i, t in rows], "source_row_index int, id string, persona string")
    kept = dedup.ordered_fold(df, "source_row_index", "id", "persona")
    assert [r.id for r in kept.orderBy("ord").collect()] == ["u1", "u2"]
    f = dedup.facts(df, "id", F.col("persona"))
    reps = dedup.representatives(dedup.profile_groups(f), f, df.select("id", F.col("source_row_index").alias("ord")))
    assert [(r.id, r.members) for r in reps.collect()] == [("u1", 2), ("u2", 1)] or len(reps.collect()) == 2


def test_ordered_dedup_of_facts_in_any_script(spark):
    rows = [(0, "我喜欢唱歌。\n我住在河边。"), (1, "我是一名医生。"), (2, "私は医者です。"), (3, "我是一名医生！")]
    df = spark.createDataFrame([(i, f"u{i}", t) for i, t in rows], "source_row_index int, id string, persona string")
    kept = dedup.ordered_fold(df, "source_row_index", "id", "persona", keep=r"\p{L}\p{N}")
    assert [r.id for r in kept.orderBy("ord").collect()] == ["u0", "u1", "u2"]


def test_registered_ordered_dedup_keeps_chinese_profiles(spark, tmp_path):
    df = spark.createDataFrame([(0, "a", "我喜欢唱歌。"), (1, "b", "我是一名医生。"), (2, "c", "我是一名医生！")], "source_row_index int, id string, persona string")
    df.write.parquet(f"{tmp_path}/users.parquet")
    assert [r.id for r in queries()["dedup_ordered"](spark, str(tmp_path)).orderBy("ord").collect()] == ["a", "b"]


MESSAGES = [("a", 0, "system", "head"), ("a", 1, "user", "q1"), ("a", 2, "Character", "r1"), ("a", 3, "USER ", "q2"), ("a", 4, "assistant", "r2"), ("a", 4, "assistant", "r2"), ("b", 1, "user", "q"), ("c", 0, "system", "h"), ("c", 1, "assistant", "x")]


def messages(spark):
    return transcript.turns(spark.createDataFrame(MESSAGES, "dialogue_id string, pos int, role string, content string"))


def test_turns_pairs_history(spark):
    t = messages(spark)
    assert t.count() == 8
    assert sorted(map(tuple, transcript.pairs(t).collect())) == [("a", 1, "q1", "r1"), ("a", 2, "q2", "r2")]
    hist = {r["round"]: r.h for r in transcript.reply_samples(t).where("dialogue_id = 'a'").select("round", transcript.history_text(F.col("history")).alias("h")).collect()}
    assert hist == {1: "1. 用户：q1", 2: "1. 用户：q1\n2. 角色：r1\n3. 用户：q2"}
    flags = {r.dialogue_id: r.ok for r in transcript.shape(t).collect()}
    assert flags == {"a": True, "b": False, "c": False}
    with pytest.raises(ValueError, match="b"):
        transcript.require_shape(t)
    assert transcript.require_shape(t, strict=False).select("dialogue_id").distinct().count() == 1
    pend = {r.dialogue_id: r.pending_message for r in transcript.pending(t).collect()}
    assert pend == {"b": "q", "c": "x"}
    rec = transcript.training_rows(t).where("dialogue_id = 'a'").first().messages
    assert [m.loss_mask for m in rec] == [0, 0, 1, 0, 1]


def test_copies_meet_before_dialogues_do(spark):
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(transcript.masked_turns(messages(spark))) == 1 and exchanges(transcript.reply_samples(messages(spark))) == 2


def test_export_keeps_first_in_string_order(spark):
    rows = [("dialogue_99999", 1, "user", "same"), ("dialogue_100000", 1, "user", "same"), ("dialogue_2", 1, "user", "other")]
    rec = transcript.training_rows(transcript.turns(spark.createDataFrame(rows, "dialogue_id string, pos int, role string, content string")))
    assert sorted(r.dialogue_id for r in transcript.training_export(rec).collect()) == ["dialogue_100000", "dialogue_2"]


def test_perspective_and_stop(spark):
    df = spark.createDataFrame([([("user", "hi"), ("character", "yo")],)], "t array<struct<speaker:string,content:string>>")
    flags = F.create_map(F.lit(1), F.lit(True))
    row = df.select(transcript.perspective(F.col("t"), "user", flags).alias("u"), transcript.actor_messages(F.lit("S"), F.col("t"), "character", "go").alias("c")).first()
    assert [m.role for m in row.u] == ["assistant", "user"] and json.loads(row.u[0].content) == {"message": "hi", "goal_completed": True}
    assert [m.role for m in row.c] == ["system", "user", "assistant"]
    stop = lambda g, n, m: spark.range(1).select(transcript.stop_reasons(F.lit(g), F.lit(n), m).alias("s")).first().s
    assert stop(True, 20, 20) == ["user_goal_completed", "max_turns"] and stop(False, 8, 8) == ["max_turns"] and stop(False, 8, 20) == []


def test_scores(spark):
    rows = spark.createDataFrame([("a", "p", 1), ("a", "p", 1), ("b", "p", 5)], "dialogue_id string, principle string, score int")
    r = scoring.aggregate(rows).first()
    assert abs(r.mean_score - 7 / 3) < 1e-12 and r.macro_mean == 3.0 and (r.n_score_1, r.n_score_3, r.n_score_5) == (2, 0, 1)
    avg = spark.createDataFrame([("a", s) for s in (1, 5, 5)], "dialogue_id string, score int")
    assert scoring.dialogue_average(avg).first().average_score == 3.6667
    stored = spark.createDataFrame([("t1", 3, "x"), ("t2", 1, "y")], "task_id string, score int, reason string")
    new = spark.createDataFrame([("t1", 3, "x"), ("t2", 5, "y"), ("t3", 1, "z")], stored.schema)
    merged, clash = scoring.merge_scores(stored, new)
    assert sorted(x.task_id for x in merged.collect()) == ["t1", "t3"] and [x.task_id for x in clash.collect()] == ["t2"]
    legacy = spark.createDataFrame([("t1", 3, "x", "c"), ("t9", 3, "x", "c"), ("t2", 3, "x", "other"), ("t3", 1, "x", "c"), ("t3", 1, "x", "c")], "task_id string, score int, reason string, ctx string")
    tasks = spark.createDataFrame([("t1", "s", "c"), ("t2", "s", "c"), ("t3", "s", "c")], "task_id string, sample_id string, ctx string")
    good, bad = scoring.migrate(legacy, tasks, ["ctx"])
    assert [x.task_id for x in good.collect()] == ["t1"] and sorted(set(map(tuple, bad.collect()))) == [("t2", "changed"), ("t3", "duplicate"), ("t9", "unknown")]
    a = scoring.batch_fingerprint(rows, {"v": 1})
    assert a == scoring.batch_fingerprint(rows.repartition(3), {"v": 1}) != scoring.batch_fingerprint(rows, {"v": 2})


def test_checks_and_lookups(spark):
    df = spark.createDataFrame([("a", " "), ("b", "x"), ("b", None)], "id string, t string")
    assert sorted(map(tuple, checks.violations(df, "id", {"t": checks.nonblank(F.col("t"))}).collect())) == [("a", "t"), ("b", "t")]
    assert [r.id for r in checks.repeated_keys(df, "id").collect()] == ["b"]
    with pytest.raises(ValueError, match="available: a, b"):
        checks.point(df, "id", "z")
    assert one(spark, '{"g": true}', lambda c: checks.strict_bool(c, "g")) is True and one(spark, '{"g": "false"}', lambda c: checks.strict_bool(c, "g")) is None
    with pytest.raises(ValueError):
        checks.client_settings({"timeout_seconds": 90, "retries": 9, "min_interval_seconds": 1})
    base = {"timeout_seconds": 90, "retries": 2, "min_interval_seconds": 1}
    end = {"base_url_env": "B", "model_env": "M", "api_key_env": "K"}
    checks.client_settings(base | {"models": {"user": end, "character": "user"}})
    checks.client_settings(base | {"judge": end | {"json_mode": True, "max_tokens": 10, "temperature": 0.5}}, judge=True)
    for wrong in ({"more": 1}, {"models": {"user": {"api_key": "x"}}}, {"models": {"user": 3}}):
        with pytest.raises(ValueError):
            checks.client_settings(base | wrong)
    for wrong in (None, {"base_url_env": "B"}, end | {"json_mode": 1}, end | {"max_tokens": True}, end | {"temperature": 3}, end | {"authorization": "x"}):
        with pytest.raises(ValueError):
            checks.client_settings(base | {"judge": wrong}, judge=True)
    rows = spark.createDataFrame([("u1", "d"), ("u2", "d"), ("u3", "d")], "uid string, remembered string")
    cat = spark.createDataFrame([("u1", "d"), ("u2", "e")], "uid string, digest string")
    ok, bad = lookups.lookup(rows, cat, "uid", "digest", "remembered")
    assert [r.uid for r in ok.collect()] == ["u1"] and sorted(map(tuple, bad.collect())) == [("u2", "changed"), ("u3", "missing")]
    with pytest.raises(ValueError):
        lookups.union_same_schema([cat, rows], "uid")
    with pytest.raises(ValueError):
        lookups.union_same_schema([cat, cat], "uid")
    svc = spark.createDataFrame([("s", [("i", "d")])], "service_name string, intents array<struct<name:string,description:string>>")
    sel = spark.createDataFrame([("s", "i"), ("s", "j")], "service_name string, intent string")
    assert {r.intent: r.description for r in lookups.select_intents(sel, svc).collect()} == {"i": "d", "j": None}


class Flaky:
    def __init__(self, answers):
        self.answers, self.sent = list(answers), []

    def __call__(self, url, data, head, timeout):
        self.sent.append(json.loads(data))
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a


def reply(text, finish="stop"):
    return json.dumps({"choices": [{"finish_reason": finish, "message": {"content": text}}], "usage": {"total_tokens": 3, "x": "y"}}).encode()


def client(*answers, **k):
    post = Flaky(answers)
    waits: list = []
    c = backend.ChatClient("http://x", "m", key="secret", spacing=0, post=post, sleep=waits.append, **k)
    return c, post, waits


def test_client_retries_and_repairs():
    c, post, waits = client(backend.classify(503), reply("cut", "length"), reply("fine"))
    assert c.complete("judge", [{"role": "user", "content": "q"}]) == "fine"
    assert [a["ok"] for a in c.attempts] == [False, False, True] and waits == [1.0, 2.0] and c.attempts[2]["usage"] == {"total_tokens": 3}
    assert "secret" not in json.dumps(c.attempts) + repr(c)
    c, post, _ = client(backend.classify(401))
    with pytest.raises(backend.RequestError):
        c.complete("judge", [])
    c, post, _ = client(reply("bad"), reply('{"a": 1}'))
    assert c.complete("judge", [{"role": "user", "content": "q"}], validate=json.loads) == '{"a": 1}'
    assert len(post.sent[1]["messages"]) == 3 and post.sent[1]["messages"][1]["content"] == "bad"
    said = lambda status, **error: str(backend.classify(status, json.dumps({"error": error}).encode() + b"\ndata: more"))
    assert "quota" in said(429, code="1310") and "not available" in said(404, message="The model x does not exist") and "own clients" in said(403, message="This account only allows Codex official clients")
    assert "secret" not in said(403, message="secret") and backend.classify(429, b"<html>").again
    for good in ('{"p": {"score": 3, "reason": "x"}}', '```json\n{"p": {"score": 1, "reason": "x"}}\n```'):
        assert backend.judge_reply(good, "p")["score"] in (1, 3)
    for bad in ('{"p": {"score": "3", "reason": "x"}}', '{"p": {"score": true, "reason": "x"}}', '{"p": {"score": 2, "reason": "x"}}', '{"p": {"score": 3.0, "reason": "x"}}', '{"p": {"score": 3, "reason": " "}}', '{"p": {"score": 3, "reason": "x", "a": 1}}', '{"q": {"score": 3, "reason": "x"}}', "[]", "no"):
        with pytest.raises(backend.FormatError):
            backend.judge_reply(bad, "p")
    with pytest.raises(backend.FormatError):
        backend.user_reply('{"message": "m", "goal_completed": "false"}')
    for body in (b"<html>", b"nope", b"[1]"):
        with pytest.raises(backend.RequestError):
            backend.parse_body(body)


def test_runner_resumes_in_the_middle(spark, tmp_path):
    jobs = spark.createDataFrame([(f"d{i}",) for i in range(6)], "dialogue_id string")
    whole = {tuple(r) for r in runner.run_batch(jobs, str(tmp_path / "one"), max_rounds=3).collect()}
    runner.run_batch(jobs, str(tmp_path / "two"), max_rounds=3, supersteps=1)
    cut = {tuple(r) for r in runner.run_batch(jobs, str(tmp_path / "two"), max_rounds=3).collect()}
    assert whole == cut
    per: dict = {}
    for d, pos, speaker, _, _ in whole:
        per.setdefault(d, []).append((pos, speaker))
    for rows in per.values():
        assert len(rows) % 2 == 0 and len(rows) <= 6 and [s for _, s in sorted(rows)] == ["user", "character"] * (len(rows) // 2)
    with exclusive(spark, str(tmp_path / "lock")):
        with pytest.raises(RuntimeError), exclusive(spark, str(tmp_path / "lock")):
            pass
    runner.check_settings({"a": 1}, {"a": 2}, started=False)
    with pytest.raises(ValueError):
        runner.check_settings({"a": 1}, {"a": 2}, started=True)


class Moody:
    """Fails for one dialogue, answers out of form once and mends it, and is fine otherwise."""

    def __init__(self):
        self.attempts, self.stub = [], backend.Stub()

    def complete(self, role, messages, validate=None):
        first = messages[0]["content"] + messages[-1]["content"]
        if "broken" in first:
            self.attempts.append({"role": role, "model": "m", "attempt": 1, "ok": False, "error": "HTTP 503", "usage": {}})
            raise backend.classify(503)
        text = self.stub.complete(role, messages)
        if role == "judge" and "malformed" in first:
            text = '{"score": 3}'
        self.attempts.append({"role": role, "model": "m", "attempt": 1, "ok": True, "error": None, "usage": {"total_tokens": 5}})
        if validate:
            validate(text)
        return text


def test_a_run_keeps_scenes_prompts_events_and_failures(spark, tmp_path):
    from dialoom.plans import api

    jobs = spark.createDataFrame([("d1", "task", "Tea", "broken kettle"), ("d2", "topic_chat", "Rain", "s"), ("d3", "open_chat", "Rain", "s")], "dialogue_id string, mode string, topic_name string, seed_situation string")
    jobs = jobs.withColumns({"user_profile": F.lit("likes maps"), "character_name": F.lit("Ann"), "character_profile": F.lit("a captain"), "tone": F.lit("gentle")})
    folder = str(tmp_path / "run")
    turns = runner.run_batch(jobs, folder, Moody, max_rounds=2)
    assert {r.dialogue_id for r in turns.collect()} == {"d2", "d3"}
    scenes = {r.dialogue_id: r.scene for r in spark.read.parquet(folder + "/scenes").collect()}
    assert scenes["d1"].trigger == "broken kettle" and scenes["d2"].background == "Rain" and scenes["d3"].background is None and scenes["d2"].user_goal is None
    failures = spark.read.parquet(folder + "/failures").collect()
    assert {(r.dialogue_id, r.phase) for r in failures} == {("d1", "user")} and all("503" in r.error for r in failures)
    events = {(r.dialogue_id, r.event) for r in spark.read.parquet(folder + "/events").collect()}
    assert {("d1", "scene"), ("d1", "failed"), ("d2", "user"), ("d2", "round"), ("d2", "end")} <= events and ("d1", "round") not in events
    attempts = spark.read.parquet(folder + "/attempts")
    assert attempts.where("dialogue_id = 'd2' AND ok").count() == turns.where("dialogue_id = 'd2'").count()
    # a later run asks only what is missing, with another backend
    more = runner.run_batch(jobs, folder, max_rounds=2)
    assert {r.dialogue_id for r in more.collect()} == {"d1", "d2", "d3"} and more.where("dialogue_id = 'd2'").count() == turns.where("dialogue_id = 'd2'").count()
    assert spark.read.parquet(folder + "/scenes").count() == 3
    # the prompts hold what each side may know
    one = runner.with_material(jobs).where("dialogue_id = 'd1'").select(*[transcript.actor_system("S", a, F.col("scene"), F.col("material")).alias(a) for a in ("user", "character")]).first()
    user, character = (json.loads(x.split("\n", 1)[1]) for x in one)
    assert user["profile"] == "likes maps" and user["user_behavior"] == {"tone": "gentle"} and user["character_public_name"] == "Ann" and user["conversation_start"]["mode"] == "task"
    assert character["profile"] == "a captain" and "conversation_mode" not in character["scene"] and "user_goal" not in json.dumps(character)


def test_scores_of_failing_malformed_and_changed_dialogues(spark, tmp_path):
    from dialoom.plans import api

    rows = [(d, p, r, c) for d, reply in (("good", "fine"), ("bad", "broken"), ("odd", "malformed"), ("new", "old words")) for p, r, c in ((0, "system", "{}"), (1, "user", "q"), (2, "assistant", reply))]
    schema = "dialogue_id string, pos int, role string, content string"
    before = spark.createDataFrame(rows, schema)
    store = str(tmp_path / "scores")
    first = api.evaluate(before, store, Moody)
    assert sum(r.n_scores for r in first.collect()) == 14
    failed = {(r.dialogue_id, r.error) for r in spark.read.parquet(store + "/failures").collect()}
    assert {d for d, _ in failed} == {"bad", "odd"} and any("503" in e for d, e in failed if d == "bad") and all("score" in e for d, e in failed if d == "odd")
    summary = json.loads((tmp_path / "scores" / "summary.json").read_text())
    assert summary["expected"] == 28 and summary["completed"] == 14
    # one reply changes: its scores no longer count and are asked again; the others stay
    after = spark.createDataFrame([(d, p, r, "new words" if c == "old words" else c) for d, p, r, c in rows], schema)
    assert sum(r.n_scores for r in api.evaluate(after, store, Moody, limit=0).collect()) == 7
    assert sum(r.n_scores for r in api.evaluate(after, store).collect()) == 28
    # a reply that changes while the judge answers is not scored
    third = spark.createDataFrame([(d, p, r, "third words" if c == "old words" else c) for d, p, r, c in rows], schema)
    kept = api.evaluate(third, store, reload=lambda: after)
    assert sum(r.n_scores for r in kept.collect()) == 21 and "changed" in {r.error for r in spark.read.parquet(store + "/failures").collect()}
    with pytest.raises(ValueError):
        api.evaluate(after, store, settings={"other": 1})
    # stored scores that contradict each other are an error
    one = spark.read.parquet(store + "/scores").where("dialogue_id = 'good'").limit(1)
    one.withColumn("reason", F.lit("another")).write.mode("append").parquet(store + "/scores")
    with pytest.raises(ValueError, match="contradict"):
        api.evaluate(after, store)


def test_options_and_legacy_scores(spark, tmp_path):
    from dialoom.plans import api

    api.check_options("generate", append=True, mode="task")
    for command, given in (("export", {"append": True}), ("generate", {"append": True, "resume": True}), ("render", {"character": "a"}), ("plan", {"resume": True, "tone": "sharp"}), ("export", {"mode": "task"})):
        with pytest.raises(ValueError):
            api.check_options(command, **given)
    tasks = spark.createDataFrame([("t1", "s", "c"), ("t2", "s", "c")], "task_id string, sample_id string, ctx string")
    old = spark.createDataFrame([("t1", 3, "x", "c")], "task_id string, score int, reason string, ctx string")
    where = str(tmp_path / "old")
    for k in range(2):
        old.write.parquet(where)
        assert api.migrate_scores(spark, where, tasks, ["ctx"], str(tmp_path / f"to{k}")) == 1
        assert spark.read.parquet(str(tmp_path / f"to{k}")).count() == 1 and not (tmp_path / "old").exists()
    assert (tmp_path / "old.legacy").exists() and (tmp_path / "old.legacy.1").exists()
    old.withColumn("ctx", F.lit("other")).write.parquet(where)
    with pytest.raises(ValueError, match="changed"):
        api.migrate_scores(spark, where, tasks, ["ctx"], str(tmp_path / "never"))
    assert (tmp_path / "old").exists() and not (tmp_path / "never").exists()
    inline = spark.createDataFrame([("d", {"round_01": [("风格一致", 3, "r")]})], "dialogue_id string, scores map<string,array<struct<dimension:string,score:int,reason:string>>>")
    flat = scoring.from_inline(inline, files.rubric(spark)).collect()
    assert [(r["round"], r.dimension_id, r.score) for r in flat] == [(1, "style_consistency", 3)]
    unknown = spark.createDataFrame([("d", {"round_01": [("nobody", 3, "r")]})], inline.schema)
    with pytest.raises(ValueError, match="nobody"):
        scoring.from_inline(unknown, files.rubric(spark))


def test_sources(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "topic_a.json").write_text("﻿" + json.dumps({"id": "g", "name": "G", "version": "1", "source": "s", "subtopics": [{"id": "x", "name": "X", "mode": "task", "seeds": ["s1"]}]}), encoding="utf-8")
    (tmp_path / "t" / "other.json").write_text("{}")
    row = files.topics(spark, str(tmp_path / "t")).first()
    assert (row.id, row.group_id, row.seeds) == ("x", "g", ["s1"])
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "ann_profile.json").write_text(json.dumps({"name": "Ann", "b": 1, "a": [2]}))
    row = files.characters(spark, str(tmp_path / "c")).first()
    from dialoom.functions.json_text import digest_of

    assert (row.id, row.name, row.tags, row.version) == ("ann_profile", "Ann", [], digest_of({"a": [2], "b": 1, "name": "Ann"}))
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "dialogue_1.progress.log").write_text("one\ntwo\n")
    (tmp_path / "l" / "dialogue_2.progress.log").write_text(json.dumps({"format_version": "2", "events": ["x"], "character_name": "Z"}))
    assert {r.dialogue_id: r.events for r in files.progress_logs(spark, str(tmp_path / "l")).collect()} == {"dialogue_1": ["one", "two"], "dialogue_2": ["x"]}
    (tmp_path / "p.csv").write_text('user 1 personas,Best Generated Conversation\n"a\nb","x ""q"""\n" ",y\nz,w\n')
    assert sorted((r.source_row_index, r[0]) for r in files.persona_csv(spark, str(tmp_path / "p.csv")).collect()) == [(0, "a\nb"), (2, "z")]
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "b.csv").write_text('user 1 personas,Best\n"e",y\n')
    (tmp_path / "csv" / "a.csv").write_text('user 1 personas,Best\n"c\nd",y\n"d",z\n')
    assert sorted((r.source_row_index, r[0]) for r in files.persona_csv(spark, str(tmp_path / "csv")).collect()) == [(0, "c\nd"), (1, "d"), (2, "e")]
    (tmp_path / "presets.json").write_text(json.dumps({"schema_version": "3.0", "presets": [{"id": "a", "tone": "sharp"}, {"id": "b", "tone": "gentle"}]}))
    assert files.presets(spark, str(tmp_path / "presets.json")).count() == 2
    with pytest.raises(ValueError, match="a, b"):
        files.presets(spark, str(tmp_path / "presets.json"), "z")
    doc = {"schema_version": "1.0", "mode_distribution": {"y": 0.5, "x": 0.5}}
    assert list(files.sampling_config(doc, {"mode": ("x", "y")})["mode"]) == ["x", "y"]
    (tmp_path / "u").mkdir()
    (tmp_path / "u" / "u.json").write_text(json.dumps({"version": "1", "format": "raw_persona", "profiles": [{"id": "U", "source_row_index": 3, "persona": "p"}]}))
    assert files.users(spark, str(tmp_path / "u")).first().source_row_index == 3
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "dialogue_7.json").write_text(json.dumps({"messages": [{"role": "system", "content": "h"}], "scene": {"conversation_mode": "task"}}))
    assert files.transcripts(spark, str(tmp_path / "d")).first().dialogue_id == "dialogue_7"
    assert files.rubric(spark).count() == 7
    env = tmp_path / ".env"
    env.write_text("A_KEY='x'\n# B=1\n")
    assert files.read_env(str(env)) == {"A_KEY": "x"}


def test_stream_scores_each_task_once(spark, tmp_path):
    from dialoom.streaming.scorer import score_stream

    schema = "dialogue_id string, round int, model_response string"
    dims = files.rubric(spark)
    go = lambda: score_stream(spark, str(tmp_path / "in"), schema, dims, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema).write.parquet(str(tmp_path / "in"))
    go()
    spark.createDataFrame([("a", 1, "x"), ("c", 1, "z")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("task_id").distinct().count() == 21


def test_commands_end_to_end(spark, tmp_path):
    from decimal import Decimal

    from dialoom.plans import api
    from dialoom.sources import sinks

    users = spark.createDataFrame([(f"u{i}", "likes tea") for i in range(6)], "id string, persona string")
    topics = spark.createDataFrame([(f"t{i}", "T", ["s1", "s2"]) for i in range(4)], "id string, name string, seeds array<string>")
    chars = spark.createDataFrame([(f"c{i}",) for i in range(3)], "id string")
    assert api.validate(users, topics, chars) == {"users": 6, "topics": 4, "characters": 3}
    with pytest.raises(ValueError, match="occurs 2"):
        api.validate(users.union(users.limit(1)), topics, chars)
    weights = {"mode": {"task": Decimal("0.5"), "topic_chat": Decimal("0.5"), "open_chat": Decimal(0)}, "tone": {"neutral": Decimal(1), "gentle": Decimal(0), "sharp": Decimal(0)}}
    folder = str(tmp_path / "batch")
    one = {r.id for r in api.plan(users, topics, chars, 4, 1, weights, folder=folder).collect()}
    two = {r.id for r in api.plan(users, topics, chars, 2, 2, weights, tone="sharp", folder=folder).collect()}
    assert one == {f"dialogue_{i:05d}" for i in range(1, 5)} and two - one == {"dialogue_00005", "dialogue_00006"}
    turns = api.generate(spark, folder, max_rounds=2, settings={"v": 1})
    assert turns.select("dialogue_id").distinct().count() == 6
    with pytest.raises(ValueError):
        api.generate(spark, folder, max_rounds=2, settings={"v": 2})
    messages = api.as_messages(turns)
    assert transcript.shape(transcript.turns(messages)).where("NOT ok").count() == 0
    n = api.export(messages, str(tmp_path / "out"), one_file=True)
    lines = [json.loads(x) for p in (tmp_path / "out").glob("*.json") for x in p.read_text().splitlines()]
    assert len(lines) == n and all(m["loss_mask"] == (m["role"] == "assistant") for x in lines for m in x["messages"])
    first = api.evaluate(messages, str(tmp_path / "scores"), limit=3)
    assert sum(r.n_scores for r in first.collect()) == 21
    again = api.evaluate(messages, str(tmp_path / "scores"))
    assert sum(r.n_scores for r in again.collect()) == 7 * transcript.pairs(transcript.turns(messages)).count()
    docs = sinks.transcript_documents(transcript.training_rows(transcript.turns(messages)), messages.select("dialogue_id").distinct().withColumn("scene", F.lit("x")))
    assert json.loads(docs.first().value)["messages"][0]["role"] == "system"
    sinks.write_transcripts(docs, str(tmp_path / "docs"))
    assert spark.read.text(str(tmp_path / "docs")).count() == 6
    for kind in ("parquet", "json", "json"):
        sinks.write_catalogue(users, str(tmp_path / kind), kind)
        assert getattr(spark.read, kind)(str(tmp_path / kind)).count() == 6
    stored = spark.createDataFrame([("t", 3, "x")], "task_id string, score int, reason string")
    assert sinks.upsert_scores(stored, stored).count() == 1
    with pytest.raises(ValueError, match="stored 3, new 5"):
        sinks.upsert_scores(stored, spark.createDataFrame([("t", 5, "x")], stored.schema))
    assert spark.sql("SELECT timestamp '2026-01-02 03:04:05' AS x").select(transcript.iso_time(F.col("x")).alias("y")).first().y == "2026-01-02T03:04:05+00:00"


def test_views_and_small_state(spark):
    users = spark.createDataFrame([("u", "i", "terse"), ("v", "j", "long")], "id string, identity string, communication_style string")
    beh = spark.createDataFrame([("u", None, "x"), ("v", "sharp", "y")], "id string, tone string, response_length string")
    rows = {r.id: r for r in transcript.user_view(users, beh).collect()}
    assert rows["u"].tone == "neutral" and rows["v"].tone == "sharp" and set(rows["u"].asDict()) == {"id", "identity", "tone"}
    scenes = spark.createDataFrame([("a", "task", "secret")], "dialogue_id string, conversation_mode string, user_private string")
    view = transcript.judge_view(messages(spark), scenes)
    assert "user_private" not in view.columns and view.count() == 2
    jobs = spark.createDataFrame([("a", "rejected", "scene"), ("b", "rejected", "user")], "id string, status string, phase string")
    assert {r.id: r.status for r in transcript.reset_rejected(jobs).collect()} == {"a": "pending", "b": "rejected"}
    models = {"judge": {"base_url_env": "B", "model_env": "M", "api_key_env": "K"}, "user": "judge"}
    assert backend.resolve_models(models, {"B": "b", "M": "m", "K": "k"})["user"]["model"] == "m"
    with pytest.raises(ValueError, match="K"):
        backend.resolve_models(models, {"B": "b", "M": "m"})
