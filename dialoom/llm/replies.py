"""Problem 2: replies that are no usable answer to the message before them.

Each defective reply gets one type, the first that applies of

``empty``           no letter once markup tags are dropped
``refusal``         every clause of the reply is part of a refusal grammar, one of them its core
``copy``            greedy string tiling covers the reply, and the question but for a word or so
``truncated``       a pushdown parser finds something open or unfinished at the end
``other_language``  the reply is mainly written in another language than the question

The endings are read by ``endings``, the copies by ``tiling``.

``defective_replies`` pairs each reply with the message at the position before by one shuffle on
stretches of dialogues, sorted within partitions, and streams through it in Arrow batches. A
dialogue is never held as a whole, and a very long one is read by several tasks.

Defined cases: redelivered rows count once (rows equal in dialogue and position); a reply whose
predecessor is missing or no user message has no question and cannot be a copy or in another
language; it is left out, as the defects are defined against a question. A null question counts
as an empty text. Null ids or positions are left out. Empty tables give an empty result; further
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions.labels import role_key
from dialoom.llm.endings import is_truncated
from dialoom.llm.letters import letters
from dialoom.llm.tiling import is_copy
from dialoom.session import ship_package

_TAG = regex.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->", regex.S)
_LETTER = regex.compile(r"[^\W_]")


# --- refusals ------------------------------------------------------------------------------

# The grammar. A refusal is a row of clauses, each of which is an opening, a core, a
# reason or a closing formula; at least one is a core.
_CORE = r"""
  (?:恕)?(?:我|本人|在下|咱)?(?:实在|暂时|现在|目前|真的|确实|也|还)*(?:无法|没法|没办法|没有办法|不能|不能够|不便|不方便|不可以|不会|不愿|拒绝|难以|无权)(?:再)?(?:对此|就此|为你|为您|向你|向您|给你|给您)?(?:回答|回应|回复|答复|讨论|谈论|提供|发表|协助|帮助|帮忙|处理|生成|参与|继续|扮演|满足|完成|评论|透露|给出|创作|说|聊|谈|做)(?P<zh>)
| 恕我(?:不能|无法|不便|难以)(?:从命|奉陪|回答|提供|相告|多说)?(?P<zh>)
| (?:这个|这类|这种|此类|该|您的|你的)?(?:请求|问题|要求|内容|话题|事情|事)(?:的内容)?我(?:暂时|实在|恐怕|目前)?(?:不能|无法|没法|没办法|不便|不可以|帮不上|无权)(?P<zh>)
| 我(?:被要求|被规定|不被允许|被禁止)(?P<zp>)
| (?:我)?帮不(?:上|了)(?:你|您|这个)?(?:的)?忙?
| (?:i\s+(?:really\s+|simply\s+)?(?:can(?:no|')?t|can\s?not|won'?t|will\s+not|am\s+(?:unable|not\s+able|not\s+allowed|not\s+permitted)|must\s+(?:decline|refuse)|have\s+to\s+(?:pass|decline|refuse)|decline|refuse)|i'm\s+(?:unable|not\s+able|not\s+allowed|not\s+permitted)|i\s+would\s+rather\s+not|i'd\s+rather\s+not)\b(?!\s+(?:believe|wait|remember|stand|recall|imagine|help\s+but|stop|get|tell\s+you\s+how|forget|see|hear|find))(?P<eo>)
| (?:my|the|our)\s+(?:guidelines?|rules?|polic(?:y|ies)|instructions?|terms?)\s+(?:do(?:es)?\s+not|don't|doesn't|forbids?|prohibits?|prevents?)(?P<en>)
| there\s+is\s+nothing\s+i\s+(?:am|'m)\s+(?:permitted|allowed|able)(?P<en>)
| (?:this|that|it)\s+(?:goes|is|falls|lies)\s+(?:beyond|outside)\s+(?:of\s+)?(?:what|my|the)(?P<en>)
| as\s+an?\s+(?:ai|language\s+model|assistant|program)[^.!?]{0,20}?,?\s*i\s+(?:can(?:no|')?t|can\s?not|won'?t|am\s+(?:unable|not\s+able))(?P<en>)
| (?:yo\s+)?no\s+(?:puedo|podré|podría|me\s+es\s+posible|me\s+está\s+permitido|estoy\s+autorizad[oa])\s*+(?!creer|esperar|dejar)(?P<en>)
| (?:esto|eso)\s+(?:va\s+más\s+allá|queda\s+fuera|supera|excede|está\s+fuera)(?P<en>)
| (?:debo|tengo\s+que)\s+(?:declinar|negarme|rechazar|abstenerme)(?P<en>)
| como\s+modelo\s+de\s+lenguaje[^.!?]{0,10}?,?\s*no\s+(?=[^.!?])(?P<en>)
| (?:я\s+)?(?:к\s+сожалению\s+)?не\s+(?:могу|смогу|имею\s+права)\s+(?:ответить|помочь|обсуждать|продолжать|говорить|участвовать|выполнить)(?P<en>)
"""
_OPEN = r"""
  (?:真的|非常|很|十分|实在)?(?:抱歉|对不起|对不住|不好意思|遗憾|不巧)
| (?:谢谢|感谢)(?:你|您)?(?:的)?(?:信任|提问|理解|关注|来信)?
| 这个嘛|嗯+|呃+|这样啊
| (?:不过|但是|但|可是|只是)
| (?:i'?m|i\s+am)\s+(?:so\s+|very\s+|really\s+|truly\s+)?(?:sorry|afraid)(?:\s+(?:about\s+that|to\s+say))?
| (?:so\s+|very\s+)?sorry|(?:my\s+)?apologies|i\s+(?:do\s+)?apologi[sz]e|unfortunately|regrettably|pardon\s+me|forgive\s+me|well|hmm+
| thanks?(?:\s+you)?\s+for\s+(?:asking|your\s+(?:trust|question|understanding|interest))
| (?:but|however|though|still)
| (?:lo\s+siento|lo\s+lamento|disculpa|disculpe|perdón|perdona|perdone|gracias\s+por\s+preguntar|lamentablemente|desafortunadamente)(?:\s+mucho)?
| (?:pero|sin\s+embargo)
| (?:大変|誠に)?(?:申し訳(?:ありません|ございません)|すみません|ごめんなさい|恐れ入ります|恐縮です|残念です|残念ながら)(?:が)?
| (?:к\s+сожалению|извините|простите|прошу\s+прощения)|но
"""
_MORE = r"""
  (?:还)?(?:请|望|敬请|希望(?:你|您)?)(?:你|您)?(?:多多?|能)?(?:谅解|理解|原谅|见谅|包涵|海涵)
| (?:请|建议|可以|不如|麻烦)(?:你|您)?(?:换|改)(?:一个|个|一下|种)?(?:别的)?(?:话题|问题|方式|问法)
| (?:建议|请)(?:你|您)?(?:向|咨询|联系|寻求)(?P<zp>)
| 如果(?:你|您)?(?:还)?有(?:别的|其他|其它|另外的?)?(?:问题|需要|话题)|(?:欢迎|请|可以)(?:随时|再)?(?:再)?(?:来)?(?:问我|告诉我|提问|找我|联系我)
| and?\s*i\s+hope\s+(?:that\s+)?you\s+(?:can\s+|will\s+)?understand|i\s+hope\s+(?:that\s+)?you\s+(?:can\s+|will\s+)?understand|(?:i\s+)?(?:thank|thanks)\s+(?:you\s+)?for\s+(?:your\s+)?understanding
| (?:please|you\s+(?:may|might|could)\s+(?:want|wish)\s+to)\s+(?:choose|pick|try|ask|consult|contact|understand|rephrase)(?P<en>)
| (?:is\s+there|if\s+(?:there\s+is|you\s+have))\s+(?:any(?:thing|\s+other)|something|another)(?P<en>)
| (?:let\s+me\s+know|feel\s+free)(?P<en>)
| since\s+(?:such|this|that)\s+(?P<en>)
| as\s+an?\s+(?:ai|language\s+model|assistant|program)(?P<ep>)
| (?:espero\s+que\s+(?:lo\s+)?(?:entienda|comprenda)s?|por\s+favor(?P<en>)|(?:elige|elija|escoge|prueba)(?P<en>)|hay\s+algo\s+más(?P<en>)|gracias\s+por\s+(?:su|tu)\s+comprensión|como\s+modelo\s+de\s+lenguaje|si\s+tiene(?P<en>)|te\s+sugiero(?P<en>)|le\s+sugiero(?P<en>))
| (?:ご了承ください|ご理解ください|ご理解いただければ幸いです|(?:別|他|ほか)の(?:話題|質問|こと)(?P<zh>)|言語モデルとして|専門家(?P<zh>)|(?:どうか|何卒)?よろしくお願い(?:いたし)?します)
| надеюсь(?P<en>)|пожалуйста(?P<en>)
"""
# Clauses with other words between their beginning and their key: the beginning, at which marks the words in
# between end, the key, at which marks what follows ends (None: with the key), and whether it is a core.
_GAPPED = (
    (r"(?:关于|对于)[^。！？!?，,]", "zp", r"[，,]?\s*我(?:暂时|实在|恐怕)?(?:不能|无法|没法|没办法|不便)", "zh", True),
    (r"(?:这|那|此)?(?:已经)?超出了?我?", "zp", r"范围|能力|权限", None, True),
    (r"as\s+an?\s+(?:ai|language\s+model|assistant|program)\b", "ep", r",?\s*\bi\s+(?:can(?:no|')?t|can\s?not|won'?t|am\s+(?:unable|not\s+able))", "en", True),
    (r"como\s+modelo\s+de\s+lenguaje(?!\s+puedo)", "ep", r",?\s*\bno\s+(?=[^.!?])", "en", True),
    (r"(?:根据|按照|依照|依据)", "zp", r"规范|规定|要求|政策|准则|守则|原则", None, False),
    (r"(?:因为|由于)?我?(?:作为|只是|毕竟是|不过是)(?:一个|一款|一名)?", "zp", r"模型|程序|助手|人工智能|AI|机器人", None, False),
)
# a Japanese core stands at the end of its sentence, after anything; what can be done is no refusal
_NOT_POSSIBLE = r"(?:でき|出来)(?:ません|ない|なく|なか|かね|兼ね|ず|ぬ|そうにも?(?:ありません|ない)|る[^。！？!?、]*?(?:が|は|も)(?:(?:おり|い|あり)ません|いない|ない))"
_GAPPED_JA = (
    r"",
    "zh",
    rf"""(?:お答え|お手伝い|回答|対応|提供|お話し?|協力|続ける\s*こと|する\s*こと|お教え|生成|参加|演じる?こと|扱うこと)(?:は|が|も|を|することは|することが)?(?:{_NOT_POSSIBLE}|いたしかね|致しかね|しかね|差し控え|控え)
    | (?:演じられ|答えられ|話せ|応じられ|できかね|お受けでき|許可されてい|認められてい)(?:ません|ない|かねます)
    | (?:範囲|能力)を(?:超えて|越えて)""",
    "zh",
    True,
)
# where a sentence ends, by the name of the group at the end of a clause that runs on; at a blank line always
_STOPS = {k: regex.compile(rf"[{v}]|\n\s*\n") for k, v in {"zh": "。！？!?", "zp": "。！？!?，,", "en": ".!?", "ep": ".!?,", "eo": ".!?。"}.items()}
_SEP = regex.compile(r"[\s,，、.。!！?？;；:：…~～\p{Cf}]*")
_BREAK = regex.compile(r"[,，、;；:：]")
_CLAUSES = tuple((regex.compile(x, regex.I | regex.X), core) for x, core in ((_OPEN, False), (_MORE, False), (_CORE, True)))
_GAPPED, _GAPPED_JA = (tuple((regex.compile(h, regex.I), gap, regex.compile(k, regex.I | regex.X), run, core) for h, gap, k, run, core in x) for x in (_GAPPED, (_GAPPED_JA,)))


def is_refusal(text: str) -> bool:
    """Whether the whole reply is made of the clauses of a refusal.

    A chart parse: from each place that clauses reach, the next clause ends where its pattern
    does. One that runs on ends with its sentence or at any break before that; as a later start
    in the sentence leads to the same ends, each end is reached once, and the stops and keys of a
    text are listed once. So neither texts nor clauses need a limit.
    """
    text = text.replace("’", "'").strip(' \t\r\n"“”「」*_>')
    breaks = [m.start() for m in _BREAK.finditer(text)]
    gapped = _GAPPED if text.isascii() or not _KANA.search(text) else _GAPPED + _GAPPED_JA
    todo, seen = [(_SEP.match(text).end(), False)], set()
    stops: dict[str, list[int]] = {}
    keys: dict[regex.Pattern, tuple[list[int], list[int]]] = {}
    low: dict[tuple, int] = {}

    def stop(kind: str, at: int) -> int:
        if kind not in stops:
            stops[kind] = [m.start() for m in _STOPS[kind].finditer(text)] + [len(text)]
        return stops[kind][bisect_left(stops[kind], at)]

    def reach(ends: list[int], first: int, last: int, core: bool, kind: object = None) -> None:
        """The ends from first to last, without those reached before."""
        known = low.get((kind, last, core), last + 1)
        if first < known:
            todo.extend((_SEP.match(text, e).end(), core) for e in ends[bisect_left(ends, first) : bisect_left(ends, known)])
            low[kind, last, core] = first

    def run_on(kind: str, at: int, core: bool) -> None:
        last = stop(kind, at)
        todo.append((_SEP.match(text, last).end(), core))
        reach(breaks, at, last, core)

    while todo:
        at, core = todo.pop()
        if at == len(text):
            if core:
                return True
            continue
        if (at, core) in seen:
            continue
        seen.add((at, core))
        for clause, is_core in _CLAUSES:
            m = clause.match(text, at)
            if m and m.lastgroup:
                run_on(m.lastgroup, m.end(), core or is_core)
            elif m and m.end() > at:
                inside = breaks[bisect_left(breaks, at + 1) : bisect_left(breaks, m.end())]
                ends = [m.end(), *(k for k in inside if clause.fullmatch(text, at, k))]
                todo += [(_SEP.match(text, e).end(), core or is_core) for e in ends]
        for head, gap, key, run, is_core in gapped:
            if not (m := head.match(text, at)):
                continue
            if key not in keys:
                found = [k.span() for k in key.finditer(text, overlapped=True)]
                keys[key] = [a for a, _ in found], [b for _, b in found]
            starts, ends = keys[key]
            last = stop(gap, m.end())
            i, j = bisect_left(starts, m.end()), bisect_right(starts, last)
            if i < j and run:
                run_on(run, ends[i], core or is_core)
            elif i < j:
                reach(ends, ends[i], ends[j - 1], core or is_core, key)
    return False


# --- copies ---------------------------------------------------------------------------------

_LEAD_BREAK = regex.compile(r"[:：,，\n]")
_MARKS = regex.compile(r"[\W_]*")
_SENTENCE_END = regex.compile(r"[.。!！?？]")


def is_quoted_at_end(question: str, bare: str, reply: str) -> bool:
    """Whether the whole question stands after a lead-in of any length; question and reply are letters.

    The lead-in is one clause up to a comma, or one sentence up to a colon or line break.
    """
    if len(question) < 4 or not reply.endswith(question):
        return False
    breaks = [m.start() for m in _LEAD_BREAK.finditer(bare)]
    i = bisect_left(breaks, -len(question), key=lambda k: -len(letters(bare[k:])))
    if i == len(breaks) or letters(bare[breaks[i] :]) != question:
        return False
    lead, marks = bare[: breaks[i]], _MARKS.match(bare, breaks[i]).group()
    return not _SENTENCE_END.search(lead) and (any(c in marks for c in ":：\n") or not _LEAD_BREAK.search(lead))


# --- languages -----------------------------------------------------------------------------

# Function words that tell the languages of the Latin script apart.
_WORDS = {
    "en": "the of and to in is was for that with my they on at it from not a an i you are be have what how would which do your this as we he she but or if no yes me there near before only".split(),
    "es": "el la los las de del que en y un una por con se su al para como más pero junto desde hasta no es lo mi tu está fue cerca también según después nunca aún ayer qué cuál quién este aquel sí ya muy tan".split(),
    "fr": "le la les des du et une est dans pour que qui pas sur avec au ce il elle je vous nous mais sont".split(),
    "de": "der die das und ist nicht ein eine ich sie mit auf für von zu den dem es wir aber wie".split(),
}
_HINT: dict[str, dict[str, float]] = {}
for _l, _ws in _WORDS.items():
    for _w in _ws:
        _HINT.setdefault(_w, {})[_l] = 1.0
_WORD = regex.compile(r"[^\W\d_]+")
_KANA = regex.compile(r"[\p{Hiragana}\p{Katakana}]+")
_HAN = regex.compile(r"\p{Han}+")
_CYR = regex.compile(r"\p{Cyrillic}+")
_HANG = regex.compile(r"\p{Hangul}+")
_LAT = regex.compile(r"\p{Latin}+")
_ACCENT = regex.compile(r"[áéíóúñ¿¡]", regex.I)


def main_language(text: str) -> tuple[str | None, float]:
    """The language a text is mainly written in, and its weight in letters (ideographs count 3)."""
    ascii_ = text.isascii()
    kana, han, cyr, hang = (0, 0, 0, 0) if ascii_ else (sum(map(len, p.findall(text))) for p in (_KANA, _HAN, _CYR, _HANG))
    lat = sum(map(len, _LAT.findall(text)))
    japanese = kana >= 0.3 * (kana + han)
    if not japanese and kana > 0.03 * han:
        # a repeated piece counts once
        bigrams = {text[i : i + 2] for i in range(len(text) - 1)}
        japanese = sum(1 for x in bigrams if _KANA.search(x)) >= 0.3 * max(1, sum(1 for x in bigrams if _KANA.search(x) or _HAN.search(x)))
    weight = {"ja" if japanese else "zh": 3 * (kana + han), "cyr": cyr, "ko": 2 * hang, "latin": lat}
    top = max(weight, key=weight.get)
    if not weight[top]:
        return None, 0.0
    if top != "latin":
        return top, weight[top]
    score = dict.fromkeys(_WORDS, 0.0)
    for w in _WORD.findall(text.lower()):
        for lang in _HINT.get(w, ()):
            score[lang] += 1.0
    score["es"] += 0.7 * len(_ACCENT.findall(text))
    best = max(score, key=score.get)
    second = sorted(score.values())[-2]
    return (best if score[best] >= second + 1 else "latin"), weight[top]


def in_other_language(question: str, reply: str) -> bool:
    """Whether the reply is mainly in another language; never on too little text to tell."""
    b, weight = main_language(reply)
    if b is None or weight < 12:
        return False
    a, _ = main_language(question)
    if a is None or a == b:
        return False
    return not ("latin" in (a, b) and {a, b} <= {"latin", *_WORDS})


# --- the operator --------------------------------------------------------------------------


def defect(question: str | None, reply: str | None) -> str | None:
    """The defect of a reply, or None."""
    text = reply or ""
    bare = _TAG.sub("", text) if "<" in text else text
    if not _LETTER.search(bare):
        return "empty"
    if is_refusal(bare):
        return "refusal"
    asked = question or ""
    if asked and 2 * len(bare) + 20 >= len(asked):
        a, b = letters(asked), letters(bare)
        if is_copy(a, b) or is_quoted_at_end(a, bare, b):
            return "copy"
    if is_truncated(text):
        return "truncated"
    if asked and in_other_language(_TAG.sub("", asked) if "<" in asked else asked, bare):
        return "other_language"
    return None


#: Positions of a dialogue that stay together in a task.
STRETCH = 2000


def defective_replies(
    messages: DataFrame, dialogue: str = "dialogue_id", pos: str = "pos", role: str = "role", content: str = "content"
) -> DataFrame:
    """``(dialogue_id, pos, defect)`` of the assistant messages that are no usable answer."""
    ship_package(messages.sparkSession)
    rows = (
        messages.select(F.col(dialogue).alias("d"), F.col(pos).cast("int").alias("p"), role_key(F.col(role)).alias("r"), F.col(content).alias("c"))
        .where("r IN ('user', 'assistant') AND d IS NOT NULL AND p IS NOT NULL")
        .withColumn("u", F.expr("r = 'user'"))
        .select("d", "p", "u", "c")
    )
    # a long dialogue is cut into stretches; the last row of one also opens the next
    stretch = F.expr(f"p div {STRETCH}")
    both = F.when(F.col("p") % STRETCH == STRETCH - 1, F.array(stretch, stretch + 1)).otherwise(F.array(stretch))
    rows = rows.select("d", "p", "u", "c", F.explode(both).alias("s"))
    ordered = rows.repartition("d", "s").sortWithinPartitions("d", "p", "s").select("d", "p", "u", "c", "s")
    schema = T.StructType(
        [T.StructField("dialogue_id", messages.schema[dialogue].dataType), T.StructField("pos", T.IntegerType()), T.StructField("defect", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None, False, None, None)
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                d, p, user, text, s = row
                if (d, p, s) == (last[0], last[1], last[4]):
                    continue
                if not user and last[0] == d and last[1] == p - 1 and last[4] == s and last[2] and (what := defect(last[3], text)):
                    out.append((d, p, what))
                last = row
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], b.schema.field(0).type), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out])],
                    names=["dialogue_id", "pos", "defect"],
                )

    return ordered.mapInArrow(run, schema)
