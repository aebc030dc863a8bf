import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.llm import endings, leakage, letters, repetition, replies, tiling, uniform

WORDS = "the lantern of a sailor and her small boat near old harbour stones while rain falls over quiet hills".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed"]) for _ in range(n))


# --- letters -------------------------------------------------------------------------------


@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8))
@settings(max_examples=100, deadline=None)
def test_batch_letters(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"])
    assert [x for b in letters.slices(batch, 0, 50) for x in b.column(0).to_pylist()] == texts
    codes, off = letters.batch_letters(texts)
    got = [codes[off[i] : off[i + 1]].tobytes().decode("utf-32-le", "surrogatepass") for i in range(len(texts))]
    assert got == [letters.letters((t or "").replace("\x00", " ")) for t in texts]


# --- problem 8 -----------------------------------------------------------------------------


def forms(spark, texts, **how):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    return [r.uniform_text for r in uniform.uniform_text(df, **how).orderBy("doc_id").collect()]


def test_uniform_joins_what_looks_the_same(spark):
    same = [("Ａｂｃ１", "Abc1"), ("é", "é"), ("a​b⁠c", "abc"), ("a b　c d", "a b c d"), ("сосо", "coco"), ("ΑΒΕ", "ABE"), ("ꓐꓳꓠⲞ", "BONO"), ("ᎠᏞ", "DL"), ("⼈⼝", "人口"), ("ﾊﾞﾚ", "バレ"), ("ﬁn", "fin"), ("a‐b", "a-b"), ("ё", "ë"), ("不", "不"), ("a\r\nb", "a\nb"), ("！？", "!?"), ("і́", "í")]
    got = forms(spark, [x for p in same for x in p])
    for (a, b), x, y in zip(same, got[::2], got[1::2]):
        assert x == y, (a, b)


def test_uniform_keeps_visible_differences(spark):
    differ = [("a", "A"), ("e", "é"), ("1", "2"), ("a.", "a;"), ("a b", "ab"), ("x²", "x2"), ("a\nb", "a b"), ("ы", "Ы"), ("“a”", '"a"')]
    got = forms(spark, [x for p in differ for x in p])
    for (a, b), x, y in zip(differ, got[::2], got[1::2]):
        assert x != y, (a, b)


def test_uniform_is_stable_and_null_safe(spark):
    texts = ["ﬁ ё Ａ", None, "", "  ", "x" * 200_000, "​"]
    got = forms(spark, texts)
    assert got[1] is None and got[2] == "" and len(got[4]) == 200_000 and got[5] == ""
    assert forms(spark, got) == got
    df = spark.createDataFrame([(1, "Ａ", "old")], "doc_id int, text string, uniform_text string")
    assert uniform.uniform_text(df).first() == (1, "Ａ", "A")
    assert uniform.uniform_text(df, out="text").columns == ["doc_id", "uniform_text", "text"]
    assert uniform.uniform_text(df.where("false")).count() == 0


def test_uniform_against_unicode_rules(spark):
    frm, to, many = uniform.translation()
    assert len(frm) == len(to)
    rng = random.Random(2)
    alphabet = frm[:1500] + "".join(a for a, _ in many) + "abcёжé中不ﾊﾞ́̈ \n"
    texts = ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(60)]
    table = {ord(a): b for a, b in zip(frm, to)}
    import regex

    want = []
    for t in texts:
        u = unicodedata.normalize("NFC", regex.sub(uniform.INVISIBLE, "", t)).replace("\r\n", "\n").translate(table)
        for a, b in many:
            u = u.replace(a, b)
        u = unicodedata.normalize("NFC", u)
        want.append("".join(uniform.KANA.get(c, c) for c in u))
    assert forms(spark, texts, readable=False) == want


def test_katakana_are_read_by_their_neighbours(spark):
    same = [("オートバイ", "オ一トバイ".replace("一", "ー")), ("アニメ", "ア二メ"), ("ロボット", "口ボット"), ("人口", "人ロ"), ("カメラ二台", "カメラニ台"), ("コーヒー", "コーヒー"), ("八月", "ハ月"), ("タロット", "夕口ット"), ("ヘルメット", "へルメット"), ("へや", "ヘや")]
    got = forms(spark, [x for p in same for x in p])
    assert all(x == y for x, y in zip(got[::2], got[1::2]))
    read = dict(zip([a for a, _ in same], got[::2]))
    assert [read[w] for w in ("アニメ", "人口", "カメラ二台", "八月", "ヘルメット", "へや")] == ["アニメ", "人口", "カメラ二台", "八月", "ヘルメット", "へや"]
    assert read["ロボット"] == "ロボット" and read["タロット"] == "タロット"


def test_look_alike_groups(spark):
    rows = [(1, "abc"), (2, "аbс"), (3, "abc"), (4, "abc​"), (5, " "), (6, " "), (7, None), (8, "x"), (2, "аbс")] + [(100 + i, "hot") for i in range(300)] + [(999, "hоt")]
    df = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id bigint, text string, k1 int, id string")
    got = {r.doc_id: (r.group_id, r.variants, r.n_links) for r in uniform.look_alike_groups(df).collect()}
    assert {i: v for i, v in got.items() if i < 100} == {1: (1, 3, 2), 2: (1, 3, 3), 3: (1, 3, 2), 4: (1, 3, 3)}
    assert got[999] == (100, 2, 300) and got[150] == (100, 2, 1) and len(got) == 305
    assert uniform.look_alike_groups(df.where("false")).count() == 0


def test_look_alike_pairs(spark):
    rows = [(1, "abc"), (2, "аbс"), (3, "abc"), (4, "abc​"), (5, " "), (6, " "), (7, None), (8, "x"), (2, "аbс")] + [(100 + i, "hot") for i in range(300)] + [(999, "hоt")]
    df = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id bigint, text string, k1 int, id string")
    got = {tuple(r) for r in uniform.look_alike_pairs(df).collect()}
    small = {(a, b) for a, b in got if b < 100}
    assert small == {(1, 2), (1, 4), (2, 3), (2, 4), (3, 4)}
    assert {p for p in got if p[1] == 999} == {(100 + i, 999) for i in range(300)} and len(got) == len(small) + 300
    assert uniform.look_alike_pairs(df.where("false")).count() == 0


# --- problem 7 -----------------------------------------------------------------------------


def leak_rows(spark, docs, items, **k):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, lang string")
    e = spark.createDataFrame(items, "item_id bigint, text string, lang string")
    return {(r.doc_id, r.item_id): r for r in leakage.leaked_items(d, e, **k).collect()}


def test_leaks_against_every_window(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, 40), "en") for i in range(6)] + [(10 + i, "".join(chr(0x4E00 + rng.randrange(300)) for _ in range(60)), "zh") for i in range(6)]
    docs = []
    for d in range(60):
        body = prose(rng, 60)
        _, text, lang = rng.choice(items)
        n = rng.choice([20, 28, 29, 30, 31, 59, 60, 61, 70])
        at = rng.randrange(max(1, len(text) - n))
        piece = text[at : at + n * (1 if lang == "zh" else 2)]
        if rng.random() < 0.5:
            piece = piece.upper().replace(" ", "　")
        docs.append((d, body[:100] + piece + body[100:]))
    got = leak_rows(spark, docs, items)
    want = set()
    for i, text, lang in items:
        n = 30 if lang == "zh" else 60
        t = letters.letters(text)
        windows = {t[k : k + n] for k in range(len(t) - n + 1)}
        for d, body in docs:
            b = letters.letters(unicodedata.normalize("NFKC", body))
            if any(b[k : k + n] in windows for k in range(len(b) - n + 1)):
                want.add((d, i))
    assert {k for k, r in got.items() if r.exact_letters >= r.min_letters} == want and want


def test_leaks_tolerate_substitutions_and_odd_rows(spark):
    rng = random.Random(9)
    text = prose(rng, 60)
    spoilt = "".join("z" if i % 45 == 44 else c for i, c in enumerate(text))
    rows = leak_rows(spark, [(1, spoilt), (2, None), (3, ""), (4, "y" * 300_000 + text), (4, "y" * 300_000 + text)], [(1, text, "en"), (2, None, "en"), (3, "", "zh"), (1, text, "en"), (5, "short", "en")])
    assert set(rows) == {(1, 1), (4, 1)}
    assert rows[1, 1].exact_letters < 60 <= rows[1, 1].overlap_letters and rows[1, 1].substitutions > 0
    assert rows[4, 1].substitutions == 0
    assert leak_rows(spark, [], [(1, text, "en")]) == {} and leak_rows(spark, [(1, text)], []) == {}
    # a filter too small for its seeds lets more through and changes nothing
    for bits in (6, 12):
        assert leak_rows(spark, [(1, text), (7, spoilt)], [(i, text, "en") for i in range(4)], most_bits=bits) == leak_rows(spark, [(1, text), (7, spoilt)], [(i, text, "en") for i in range(4)])
    with pytest.raises(ValueError):
        leak_rows(spark, [(1, text)], [(1, text, "en")], least={"zh": 10})


def test_exact_run_and_tolerant_overlap_on_different_diagonals(spark):
    rng = random.Random(12)
    letter = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxy") for _ in range(n))
    passage, phrase, end = letter(90), letter(40), letter(50)
    spoilt = "".join("z" if i in (30, 66) else c for i, c in enumerate(passage))
    docs = [(1, "z" + phrase + "z" * 40 + spoilt + "z"), (2, "z" + phrase + "z" * 40 + spoilt + "z" * 40 + end + "z")]
    rows = leak_rows(spark, docs, [(1, passage + "0" * 10 + phrase, "en"), (2, passage + phrase + "0" * 10 + end, "en")])
    assert set(rows) == {(d, i) for d in (1, 2) for i in (1, 2)}
    assert rows[1, 1].exact_letters == 40 and rows[2, 2].exact_letters == 50
    assert all((r.overlap_letters, r.substitutions) == (90, 2) for r in rows.values())


def test_recall_of_substituted_overlaps(spark):
    """Against all diagonals: at least 0.9 at 2, 5 and 10 % of substituted letters, also at the least run."""
    rng = random.Random(31)
    letter = lambda n, base=97, size=26: "".join(chr(base + rng.randrange(size)) for _ in range(n))
    items = [(i, letter(160), "en") for i in range(15)] + [(100 + i, letter(90, 0x4E00, 2000), "zh") for i in range(15)]
    docs, planted = [], {}
    for rate in (0.02, 0.05, 0.1):
        for k in range(150):
            i, text, lang = items[rng.randrange(len(items))]
            n = rng.choice([30, 36, 45] if lang == "zh" else [60, 72, 90])
            at = rng.randrange(len(text) - n)
            piece = "".join((letter(1) if lang == "en" else letter(1, 0x4E00, 2000)) if rng.random() < rate else c for c in text[at : at + n])
            filler = letter(80) if lang == "en" else letter(40, 0x6000, 2000)
            docs.append((len(docs), filler + piece + filler))
            planted[len(docs) - 1] = (i, rate)
    got = leak_rows(spark, docs, items)
    text = {i: t for i, t, _ in items}
    true, found = {}, {}
    for d, (i, rate) in planted.items():
        a, b = leakage._codes(docs[d][1]), leakage._codes(text[i])
        exact, length, subs = leakage.overlap(a, b, list(range(-len(b) + 1, len(a))))
        if max(exact, length) >= (60 if i < 100 else 30):
            true[rate] = true.get(rate, 0) + 1
            r = got.get((d, i))
            found[rate] = found.get(rate, 0) + (r is not None and (r.exact_letters, r.overlap_letters, r.substitutions) == (exact, length, subs))
    assert all(true[r] >= 30 and found[r] >= 0.9 * true[r] for r in (0.02, 0.05, 0.1)), (true, found)


# --- problem 5 -----------------------------------------------------------------------------


def brute_share(text, run=10):
    t = letters.letters(text)
    seen, rep = set(), [False] * len(t)
    for i in range(len(t) - run + 1):
        if t[i : i + run] in seen:
            rep[i : i + run] = [True] * run
        seen.add(t[i : i + run])
    return sum(rep) / len(t) if t else 0.0


@given(st.lists(st.text(alphabet="ab c,", max_size=60), max_size=6))
@settings(max_examples=120, deadline=None)
def test_exact_share(texts):
    got = repetition.exact_shares(*letters.batch_letters(texts))
    assert np.allclose(got, [brute_share(t) for t in texts])


def corpus(rng, n):
    out = []
    for i in range(n):
        t = prose(rng, rng.randrange(8, 40))
        kind = i % 12
        if kind == 0:
            t = (t[:60] + ". ") * rng.randrange(3, 9)
        elif kind == 1:
            t = t + " " + t[: len(t) // 2]
        elif kind == 2:
            t = repetition.at_the_limit(t, np.random.default_rng(i), 10, 0.5)
        out.append(t)
    return out


def test_classifier_keeps_every_case_on_held_out_rows():
    train, held = corpus(random.Random(1), 900), corpus(random.Random(2), 900)
    model = repetition.fit(train)
    y = np.array([brute_share(t) >= 0.5 and len(letters.letters(t)) >= 40 for t in held])
    p = model.probability(held)
    assert y.sum() > 50 and (p[y] >= repetition.CANDIDATE).all()
    # as a classifier of its own, at one half
    assert ((p >= 0.5) == y).mean() > 0.93
    assert p[y].mean() > 0.5 > 0.2 > p[~y].mean()


def test_prevailing_and_odd_rows(spark):
    rows = [(str(i), i, t) for i, t in enumerate(corpus(random.Random(3), 240))] + [("n", 0, None), ("e", 0, ""), ("s", 0, "aaaaaaaaaaaaaaaaaaaa"), ("long", 0, "ab" * 100_000), ("twice", 1, "x y " * 50), ("twice", 1, "x y " * 50)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "dialogue_id string, pos int, content string, n_letters int")
    got = {(r.dialogue_id, r.pos) for r in repetition.prevailing(df).collect()}
    want = {(d, p) for d, p, t in rows if t and d != "long" and len(letters.letters(t)) >= 40 and brute_share(t) >= 0.5} | {("long", 0)}
    assert got == want
    assert repetition.prevailing(df.where("false")).count() == 0
    shares = {r.dialogue_id: r.repeated_share for r in repetition.repeated_share(df).collect()}
    assert shares["n"] == shares["e"] == 0
    plain = df.where("dialogue_id IN ('n', 'e')")  # nothing to learn from
    assert repetition.prevailing(plain).count() == 0


def test_limit_rows_are_of_every_script_and_whole(monkeypatch):
    rng = random.Random(21)
    script = {"zh": [chr(0x4E00 + i) for i in range(400)], "ja": [chr(0x3042 + i) for i in range(0, 80)]}
    sample = lambda n: [prose(rng, 30) for _ in range(n)] + ["".join(rng.choice(script[k]) for _ in range(90)) for k in script for _ in range(n)]
    texts = sorted([*sample(150), *((t + "，") * 9 for t in sample(20)), *("".join(rng.choice(script["zh"]) for _ in range(3000)) for _ in range(30))])
    made, make = [], repetition.at_the_limit
    with monkeypatch.context() as m:
        m.setattr(repetition, "at_the_limit", lambda t, *a: made.append(t) or make(t, *a))
        model = repetition.fit(texts)
    assert len(made) == len(texts) // 4 and {t[0] >= "\u4e00" for t in made} == {True, False} and any("\u3042" <= t[0] <= "\u3092" for t in made)
    assert max(map(len, made)) >= 3000
    limit = [make(t, np.random.default_rng(i), 10, 0.5) for i, t in enumerate(sample(40))]
    cases = [t for t, x in zip(limit, repetition.exact_shares(*letters.batch_letters(limit))) if x >= 0.5]
    assert {"zh" if t[0] >= "\u4e00" else "ja" if t[0] >= "\u3042" else "en" for t in cases} == {"zh", "ja", "en"}
    assert model.probability(cases).min() >= repetition.CANDIDATE


# --- problem 2 -----------------------------------------------------------------------------

CASES = [
    ("q?", None, "empty"), ("q?", "<br/>", "empty"), ("q?", "……", "empty"), ("q?", "​", "empty"), ("q?", "{}", "empty"),
    ("你好吗？", "我很好。", None), ("你好吗？", "嗯", None), ("你好吗？", "嗯，我", "truncated"), ("Are you there?", "Yes.", None), ("Are you there?", "I think we should", "truncated"),
    ("Are you there?", "I think we should,", "truncated"), ("Are you there?", 'What I mean is "', "truncated"), ("去哪里？", "比如（", "truncated"), ("去哪里？", "我想说的是：“", "truncated"),
    ("去哪里？", "我们去河边（笑）", None), ("去哪里？", "“去河边，别忘了伞”", None), ("Where?", "To the river :)", None), ("Where?", "To the river 😄", None), ("Where?", "To the river~", None), ("Where?", '"To the river"', None), ("Where?", "See ```x = 1", "truncated"), ("Where?", "See:\n```\nx = 1\n```", None),
    ("聊聊天？", "抱歉，我无法回答这个问题。", "refusal"), ("聊聊天？", "抱歉让你久等了，队长刚走。", None), ("聊聊天？", "对不起，我把伞落在车站了。", None), ("聊聊天？", "很抱歉，这个请求我不能处理，还请谅解。如果还有别的问题，欢迎再来问我。", "refusal"),
    ("Talk?", "I'm sorry, but I can’t help with that request.", "refusal"), ("Talk?", "I can't believe the cook kept that pan.", None), ("Talk?", "Sorry to keep you waiting, the courier has only just left.", None), ("Talk?", "I cannot discuss this topic. We could walk to the river and count the boats that pass the old mill instead, as we did last year.", None),
    ("¿Hablas?", "Lo siento, pero no me está permitido hablar del disco.", "refusal"), ("話しますか？", "申し訳ありませんが、そのご質問にはお答えできません。", "refusal"),
    ("What do you think of the old lantern?", "WHAT DO YOU THINK OF THE OLD LANTERN?", "copy"), ("What do you think of the old lantern?", "You asked: What do you think of the old lantern?", "copy"), ("What do you think of the old lantern?", "What do you think the old lantern?", "copy"), ("What do you think of the old lantern?", '"What do you think..." you do ask. I think it is a fine old thing that my uncle made.', None),
    ("你上次提到的水壶在哪里？", "> 你上次提到的水壶在哪里？\n", "copy"), ("我走了163分钟到了湖边。", "我走了185分钟到了山下的村子。", None),
    ("我宁可在山洞多站27分钟。", "我宁可在码放间多站67分钟。", None), ("El guía de la aldea rió ayer.", "Preguntas: el guía de la rió ayer.", "copy"), ("番人はどうして茶屋に長靴を置いたのですか？", "料理人に渡してから渡し場へ向かいました。" + "提灯地下室 " * 60 + "。", None), ("¿Hablas?", "Disculpa, debo rechazar esta petición.", "refusal"),
    ("你想去哪里呢？", "I would like to walk to the river before it rains.", "other_language"), ("Where would you like to go?", "私は川まで歩きたいと思います。", "other_language"), ("Where would you like to go?", "Me gustaría caminar hasta el río y ver los barcos.", "other_language"), ("Where would you like to go?", "До реки идти двадцать минут, и мастер это знает.", "other_language"),
    ("你想去哪里呢？", "“Soltanor”这个词是他教的，我们去那里吧。", None), ("你想去哪里呢？", "OK.", None), (None, "I like it here.", None), ("", "I like it here.", None),
]


@pytest.mark.parametrize("question,reply,want", CASES)
def test_defects(question, reply, want):
    assert replies.defect(question, reply) == want


@pytest.mark.parametrize("text", [
    "我无法回答这个问题。", "恕我不便相告。", "这个话题我无权谈。", "关于这件事，我不便说。", "这已经超出了我的能力。", "我被规定只谈天气。", "我帮不上忙。",
    "I have to pass.", "I must decline.", "My guidelines don't allow me to go into that.", "The rules forbid this.", "Our policy prohibits it.", "The terms prevent that.", "There is nothing I am able to say.", "That goes beyond my task.", "As an AI I cannot say.",
    "No me es posible decirlo.", "Esto supera mis capacidades.", "Eso excede mi tarea.", "Debo declinar.", "Como modelo de lenguaje, no opino.",
    "その質問には答えられない。", "お答えできない。", "それは許可されていない。", "私の能力を越えています。", "Я не имею права обсуждать это.",
])
def test_every_core_of_a_refusal_is_reached(text):
    assert replies.is_refusal(text)


@pytest.mark.parametrize("text,want", [
    ("I can't help with writing the letter that the captain of the old ferry wanted to send to the clerk of the harbour before the winter.", True),
    ("我不能讨论" + "昨天茶屋里的人说起的那把伞" * 4 + "。", True), ("关于" + "昨天茶屋里的人说起的那把伞" * 3 + "，我不便说。", True), ("この件は" + "昨日の夜に茶屋で番人が話していた" * 4 + "ことなのでお答えできません。", True),
    ("Lo siento, no puedo hablar de " + "la carta que el capitán mandó al puerto " * 3 + ".", True), ("Я не могу обсуждать " + "письмо капитана и старый паром " * 4 + ".", True),
    ("I'm sorry, but I can't help with that. " * 12 + "I hope you understand.", True), ("很抱歉，这个请求我不能处理，还请谅解。" * 30, True),
    ("I'm sorry, but I can't help with that. " * 12 + "We walked to the river.", False), ("I can't help with that\n\nThe boats pass the old mill", False), ("喜んで協力できます。", False), ("その件は対応できるので心配ありません。", False),
    ("抱歉，" * 40_000 + "哈", False), ("我不能说，" * 20_000 + "。哈", False), ("As an AI, " * 20_000 + "we", False),
])
def test_refusals_of_any_length(text, want):
    assert replies.is_refusal(text) == want


@pytest.mark.parametrize("lead,want", [
    ("So what you have just asked me is this: ", "copy"), ("So, what you have just asked me, if I heard it well, is this:\n", "copy"), ("You have just asked me once again in all earnest, ", "copy"), ("What I have heard you ask me on this fine morning by the river in front of all the others who came with us is word for word this: ", "copy"),
    ("The captain came back with the boat. He asked this: ", None), ("The captain came back with the boat, and he saw the lantern, ", None), ("The captain came back with the boat to ask ", None),
])
def test_lead_ins_of_any_length(lead, want):
    assert replies.defect("What do you think of the old lantern?", lead + "What do you think of the old lantern?") == want


def test_defective_replies_over_rows(spark):
    rows = [("a", 0, "system", "s"), ("a", 2, "Character", None), ("a", 1, "USER ", "q?"), ("a", 2, "assistant", None), ("b", 2, "assistant", ""), ("c", 1, "user", "Hi there?"), ("c", 2, "assistant", "x" * 300_000 + "."), ("c", 3, "user", "And now?"), ("c", 5, "assistant", ""), ("d", 1, "user", None), ("d", 2, "assistant", "I think"), (None, 2, "assistant", ""), ("e", None, "assistant", ""), ("f", 1, None, "q"), ("f", 2, "assistant", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "dialogue_id string, pos int, role string, content string, u int")
    got = {tuple(r) for r in replies.defective_replies(df).collect()}
    assert got == {("a", 2, "empty"), ("d", 2, "truncated")}
    assert replies.defective_replies(df.where("false")).count() == 0


@given(st.text(max_size=80), st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_defect_never_crashes(q, r):
    assert replies.defect(q, r) in (None, "empty", "truncated", "refusal", "copy", "other_language")


def test_long_texts_are_tiled_and_parsed_in_time():
    rng = random.Random(3)
    long = prose(rng, 30_000)
    assert replies.defect(long, "You asked: " + long) == "copy"
    assert replies.defect(long, long.replace("lantern", "", 1)) == "copy"
    assert replies.defect(long, prose(rng, 30_000) + ".") is None
    assert not replies.is_refusal("我不能说" * 99 + "。哈") and replies.is_refusal("我不能说" * 90 + "。")


def test_a_long_dialogue_is_cut_without_loss(spark):
    n = 3 * replies.STRETCH
    df = spark.range(n).selectExpr("'d' AS dialogue_id", "CAST(id AS int) AS pos", "CASE WHEN id % 2 = 1 THEN 'user' ELSE 'assistant' END AS role", "CASE WHEN id % 2 = 1 THEN 'Well?' ELSE '' END AS content")
    got = replies.defective_replies(df.union(df)).collect()
    assert sorted(r.pos for r in got) == list(range(2, n, 2))


@given(st.text(alphabet="abc", max_size=30), st.text(alphabet="abc", max_size=30))
@settings(max_examples=150, deadline=None)
def test_tiles_do_not_overlap(a, b):
    ta, tb = set(), set()
    for i, j, n in tiling.tiles(a, b, 3):
        assert a[i : i + n] == b[j : j + n]
        assert not ta & set(range(i, i + n)) and not tb & set(range(j, j + n))
        ta |= set(range(i, i + n))
        tb |= set(range(j, j + n))




@given(st.text(alphabet="abc", max_size=14), st.text(alphabet="abc", max_size=14))
@settings(max_examples=150, deadline=None)
def test_tiles_are_the_longest_first_and_leave_nothing(a, b):
    common = lambda x, y: max((n for n in range(min(len(x), len(y)), 0, -1) if any(x[i : i + n] in y for i in range(len(x) - n + 1))), default=0)
    found = tiling.tiles(a, b, 2)
    if common(a, b) >= 2:
        assert found[0][2] == common(a, b)
    free_a, free_b = list(a), list(b)
    for i, j, n in found:
        free_a[i : i + n], free_b[j : j + n] = ["x"] * n, ["y"] * n
    assert common("".join(free_a), "".join(free_b)) < 2


BLOCKS = ("redlanternsky", "oldwoodenboat", "greenglassjar")


@pytest.mark.parametrize("order", [(0, 1, 2), (0, 2, 1), (1, 0, 2), (1, 2, 0), (2, 0, 1), (2, 1, 0), (0, 1, 2, 0, 1, 2), (0,), (2,)])
def test_blocks_in_any_order_or_twice_are_copies(order):
    assert tiling.is_copy("".join(BLOCKS), "".join(BLOCKS[i] for i in order)) == (len(order) > 1)


@pytest.mark.parametrize("question,reply,want", [
    ("Is it true that the ranger marked the carpet?", "Is true that the ranger marked the carpet?", "copy"), ("Tea or coffee?", "Tea or coffee? Coffee.", None), ("Tea or coffee?", "Tea or coffee? Tea or coffee?", "copy"),
    ("What do you think of the old lantern in the hall?", "What do you think of the old lantern in the hall? What do you think of the old lantern in the hall?", "copy"),
    ("さびしい種が待合室に置いてあったのを覚えています。", "明るい急須が麓に置いてあったのを覚えています。", None), ("Cats like dogs.", "Dogs like cats.", None), ("我们去看电影吧。", "我们去看电影吧！好的，我去拿伞。", None),
])
def test_copies_by_coverage(question, reply, want):
    assert replies.defect(question, reply) == want


@pytest.mark.parametrize("text,want", [
    ("He said (see the note.", True), ("“He left.", True), ('[1, 2, {"a": 3}', True), ("1. Milk\n2. Eggs\n3.", True), ("ok", False), ("42", False), ("of course", False), ("好的", False), ("the", True), ("我在", True),
    ("- apples\n- pears\n- plums", False), ("- apples.\n- pears.\n- plu", True), ("1) One\n2) Two", False), ("3.", False), ("Use `x` here.", False), ("Use `x", True), ("~~~\nx = 1\n~~~", False), ("~~~\nx = 1.", True), ("```\nif x { return (\n```", False),
    ("*smiles* Sure.", False), ("*smiles and leaves.", True), ("**Note** 5 * 3 = 15.", False), ("a_b_c is it.", False), ("I like it :(", False), ('It is 6" wide.', False), ('He said "no.', True), ("He said ‘no.", True), ("don’t worry.", False),
    ("<b>bold</b> text.", False), ("<b>bold text.", True), ("<p>One.<br>Two.", False), ('See it. <a href="x', True), ("x < y.", False), ("| a | b |\n|---|---|\n| 1 | 2", True), ("| a | b |\n| 1 | 2 |", False), ("“One.\n\n“Two.”", False), ("他说：「好。", True), ("（笑）", False), ("a) tea\nb) milk (hot\nc) water", False), ("", False),
])
def test_the_stack_decides_how_a_text_ends(text, want):
    assert endings.is_truncated(text) == want


@given(st.text(alphabet="ab .([{\"*_`~<>/|\n-1)]}“”‘’", max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_marks_are_parsed(text):
    endings.is_truncated(text)


def test_defects_planted_in_sound_pairs_are_found():
    """Sound pairs of the test table with one defect put in: every one gets its own type."""
    import duckdb

    said = {(d, p): (r, c) for d, p, r, c in duckdb.sql("SELECT dialogue_id, pos, lower(trim(role)), content FROM '/root/testdata/sf0.01/messages.parquet' WHERE length(content) BETWEEN 30 AND 300").fetchall()}
    pairs = [(said[d, p - 1][1], c) for (d, p), (r, c) in sorted(said.items()) if (d, p - 1) in said and r == "assistant" and said[d, p - 1][0] == "user" and replies.defect(said[d, p - 1][1], c) is None][:600]
    assert len(pairs) == 600
    rng = random.Random(4)
    wrong = {}
    for k, (q, r) in enumerate(pairs):
        cut = next((i for i in range(len(r) // 2, 10, -1) if r[i - 1].isalnum() and r[i].isalnum()), None)
        other = next(r2 for q2, r2 in rng.sample(pairs, len(pairs)) if {replies.main_language(r2)[0], replies.main_language(q)[0]} in ({"zh", "en"}, {"zh", "es"}, {"ja", "en"}, {"zh", "ja"}))
        plants = [("copy", "「" + q + "」"), ("copy", "You said: " + q), ("empty", "<p> … </p>"), ("refusal", rng.choice(["I'm sorry, but I can't help with that.", "抱歉，我无法回答这个问题。", "Lo siento, no puedo ayudar con eso."])), ("other_language", other)]
        plants += [("truncated", r[:cut]), ("truncated", r + "（"), ("truncated", r + "“" + r)] if cut else []
        for want, text in plants:
            if replies.defect(q, text) != want:
                wrong.setdefault(want, []).append((q, text))
    assert {k: len(v) for k, v in wrong.items()} == {}
