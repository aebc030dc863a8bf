"""How a text ends: a pushdown parser of fences, code, brackets, quotations, lists, tables, markup and tags.

The parser reads the text once. Marks that open are pushed, marks that close pop what they close;
what is still on the stack at the end decides first, then the last thing read:

* anything open - a fence, inline code, a bracket, a quotation, emphasis in the last paragraph, a
  tag that needs an end - means that the text breaks off, also behind a full stop;
* so do a tag cut short, a list mark with nothing behind it, a table row without its end, and a
  pause or opening mark;
* a text that ends with a letter breaks off, unless it is a whole answer without an end mark: a
  word or two that can stand alone, a number, or the last item of a list whose items have none.

Defined cases: an empty text does not break off; faces such as ``:(``, list marks such as ``a)``,
apostrophes, signs of inches, products and names with underscores open nothing; a closing mark
without its opening one closes nothing; a quotation that is opened again at the beginning of a
paragraph is one quotation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import regex

# Marks by what they do.
OPENING = {
    "(": ")", "（": "）", "[": "]", "［": "］", "【": "】", "{": "}", "｛": "｝", "《": "》", "〈": "〉", "「": "」", "『": "』", "〔": "〕", "“": "”", "‘": "’", "«": "»", "‹": "›", "„": "“",
}
CLOSING = {b: a for a, b in OPENING.items() if b != "“"}
LEADING = set("¿¡")
TERMINAL = set(".。!！?？…‥．｡~～♪♥❤")
PAUSE = set(",，、;；:：-–—－､·/\\=+&")
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
OPTIONAL_TAGS = set("html head body p li dt dd option optgroup tr td th thead tbody tfoot colgroup rt rp".split())
#: Words of which none can be a whole answer.
UNFINISHED = set(
    "a an the and or but if so of to in on at by for from with as than that because while when although though is are was were be been am do does did has have had "
    "will would can could should may might must i you he she we they it my your his her our their this these those there not "
    "el la los las un una unos unas y o pero si de del a al en con por para que como cuando aunque es son era yo tú mi tu su "
    "и но или если в на с по для что как когда хотя я ты он она мы они".split()
)
UNFINISHED_HAN = set("我你您他她它咱这那在是和与及或但而且因如若把被对向从给让叫使为以于将很更最太还也都就才又再的地得着过")
#: Answers of two or more words, and of more than two ideographs, that stand without an end mark.
WHOLE = set(
    "of course|not really|not yet|no idea|thank you|thanks a lot|all right|no problem|not at all|for sure|no way|me too|why not|good night|good morning|see you|"
    "yes please|no thanks|no thank you|por supuesto|claro que sí|claro que no|muchas gracias|de nada|buenas noches|buenos días|"
    "没问题|没关系|不客气|谢谢你|谢谢您|当然了|当然可以|不知道|没有了|可以的|好的呀|はい|いいえ|うん|ううん|もちろん|わかりました|ありがとう|конечно|не знаю|спасибо".split("|")
)

_TAG = regex.compile(r"<(/?)([A-Za-z][\w:-]*)(?:\s[^<>]*?)?(/?)>|<!--.*?-->", regex.S)
_CUT_TAG = regex.compile(r"<(?:/?[A-Za-z][\w:-]*(?:\s+[\w:-]+(?:\s*=\s*(?:\"[^\"<>]*\"?|'[^'<>]*'?|[^\s<>\"']*))?)*\s*/?|!--(?:(?!-->).)*|/)$", regex.S)
_LIST_MARK = regex.compile(r"[ \t]*(?:([-*•+‣·])|(?:[(（])?(\d{1,3}|[a-zA-Z]|[一二三四五六七八九十]{1,3})[.)、）．])(?:[ \t]+|$|(?<=[、）])(?=\S)|(?=\n))", regex.M)
_FACE = regex.compile(r"[:;=8xX][-'^o]?[()\[\]{}|]+(?![\w])")
_FENCE = regex.compile(r"`{3,}|~{3,}(?=[ \t]*\w*[ \t]*(?:\n|$))")
_UNSEEN = regex.compile(r"[\s\p{Cf}\p{Cc}\p{Z}]+$")
_WORDS = regex.compile(r"[\p{L}\p{M}\p{N}]+(?:['’-][\p{L}\p{M}\p{N}]+)*")
_NUMBER = regex.compile(r"[$€£¥№#]?\s*[+-]?\d[\d.,:/ %°-]*\s*(?:[ap]m|[\p{L}%°]{1,2})?")
_IDEOGRAPHIC = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]")
#: All that the parser must look at; what stands between is only letters, blanks, and marks of ends and pauses.
_LOOK = regex.compile("[" + regex.escape("".join({*OPENING, *CLOSING, *LEADING}) + "`~\n\r\"*_<|:;=8xX") + "]")
_PLAIN = regex.compile("[^" + regex.escape("".join({*OPENING, *CLOSING, *LEADING}) + "`\n\r\"*_<|") + "]*")


@dataclass
class Ending:
    """What the parser knows at the end of a text."""

    kind: str = "none"  # none, terminal, closing, opening, pause, letter or symbol
    stack: list[str] = field(default_factory=list)
    #: A list mark with nothing behind it, a table row or tag that is not finished.
    cut: bool = False
    #: The last line is an item of a list whose earlier items end without a mark.
    plain_item: bool = False


def _kind(c: str) -> str | None:
    if c in TERMINAL:
        return "terminal"
    if c in PAUSE:
        return "pause"
    if c.isalnum() or regex.match(r"\p{M}", c):
        return "letter"
    return None if _UNSEEN.match(c) else "symbol"


def _last_kind(text: str, lo: int, hi: int) -> str | None:
    """What the last visible character between two places is."""
    for i in range(hi - 1, lo - 1, -1):
        if k := _kind(text[i]):
            return k
    return None


def parse(text: str) -> Ending:
    """Reads the text with a stack of open marks; see the module's rules."""
    out = Ending()
    if _PLAIN.fullmatch(text) and not _FACE.search(text) and "~~~" not in text and not _LIST_MARK.match(text):
        out.kind = _last_kind(text, 0, len(text)) or "none"  # one line without any mark to be read
        return out
    stack, i, n = out.stack, 0, len(text)
    line_start, before, item = True, "\n", None
    item_ends: list[str] = []  # how the items of the list so far ended
    rows_closed, in_row = 0, False

    def pop(mark: str) -> bool:
        if mark not in stack:
            return False
        while stack.pop() != mark:
            pass
        return True

    def end_line() -> None:
        nonlocal item, in_row, rows_closed
        if item is not None:
            item_ends.append("mark" if out.kind == "opening" and item == "bare" else out.kind)
            item = None
        if in_row:
            rows_closed += before == "|"
            in_row = False

    while i < n:
        c = text[i]
        if stack and stack[-1][:1] in "`~" and len(stack[-1]) > 2:  # inside a fence only its end counts
            if c == stack[-1][0] and text.startswith(stack[-1], i):
                i += len(stack.pop())
                while i < n and text[i] == c:
                    i += 1
                out.kind, before, line_start = "closing", c, False
            else:
                out.kind = _kind(c) or out.kind
                before, i = c, i + 1
            continue
        if m := _FENCE.match(text, i):
            stack.append(m.group())
            out.kind, before, i, line_start = "opening", c, m.end(), False
            continue
        if c == "`":
            j = i
            while j < n and text[j] == "`":
                j += 1
            if not pop(text[i:j]):
                end = text.find(text[i:j], j)
                paragraph = text.find("\n\n", j)
                if end >= 0 and (paragraph < 0 or end < paragraph):
                    out.kind, before, i, line_start = "closing", "`", end + j - i, False
                    continue
                if paragraph < 0:
                    stack.append(text[i:j])
                    out.kind = "opening"
                    break
                out.kind = "symbol"
            i, before, line_start = j, "`", False
            continue
        if c in "\n\r":
            if c == "\n":
                blank = text[i + 1 :].lstrip(" \t\r")[:1] == "\n" if i + 1 < n and text[i + 1] in " \t\r\n" else False
                end_line()
                if blank:
                    # emphasis ends with its paragraph
                    stack[:] = [x for x in stack if x[0] not in "*_"]
                line_start = True
            before, i = c, i + 1
            continue
        if line_start and not c.isspace():
            line_start = False
            start = text.rfind("\n", 0, i) + 1
            if m := _LIST_MARK.match(text, start):
                # a bracket left open by an item does not reach over the next one
                if item_ends:
                    stack[:] = [x for x in stack if x not in "([{（【"]
                item = "bare"
                out.kind, before, i = "opening", " ", m.end()
                continue
            if c == "|":
                in_row = True
            elif item_ends and text[start:i] == "" and before == "\n":
                item_ends = [] if text[max(0, start - 2) : start] == "\n\n" else item_ends
            if c in OPENING and c in stack and c in "“「『«":
                before, i = c, i + 1  # opened again at the beginning of a paragraph
                continue
        if not c.isspace() and item == "bare":
            item = "filled"
        if c == "<" and (m := _TAG.match(text, i)):
            closes, name, empty = m.group(1), (m.group(2) or "").lower(), m.group(3)
            if name and closes:
                pop(f"<{name}>")
                out.kind = "closing" if out.kind in ("opening", "none") else out.kind
            elif name and not empty and name not in VOID_TAGS and name not in OPTIONAL_TAGS:
                stack.append(f"<{name}>")
            i = m.end()
            continue
        if c == "<" and _CUT_TAG.match(text, i):
            out.cut = True
            break
        if c in ":;=8xX" and not before.isalnum() and (m := _FACE.match(text, i)):
            out.kind, before, i = "symbol", ")", m.end()
            continue
        if c in "*_" or (c == '"'):
            j = i + 1
            while c != '"' and j < n and text[j] == c:
                j += 1
            mark, after = text[i:j], text[j] if j < n else " "
            left, right = not after.isspace(), not before.isspace()
            wordy = before.isalnum() and after.isalnum() and not (_IDEOGRAPHIC.match(before) or _IDEOGRAPHIC.match(after))
            if c == '"':
                if pop('"'):
                    out.kind = "closing"
                elif not (before.isdigit() and not after.isalnum()):
                    stack.append('"')
                    out.kind = "opening"
            elif len(mark) > 3 or (c == "_" and wordy):
                out.kind = "symbol"
            elif right and mark in stack:
                pop(mark)
                out.kind = "closing"
            elif right and len(mark) == 3 and mark[:2] in stack:
                pop(mark[:2])
                pop(mark[:1])
                out.kind = "closing"
            elif left and not wordy and not (before.isalnum() and not _IDEOGRAPHIC.match(before)):
                stack.append(mark)
                out.kind = "opening"
            else:
                out.kind = "symbol" if not right or out.kind == "opening" else out.kind
            before, i = c, j
            continue
        if c == "“" and "„" in stack:
            pop("„")
            out.kind = "closing"
        elif c in OPENING:
            if c == "‘" and before.isalnum():
                out.kind = "letter"
            else:
                stack.append(c)
                out.kind = "opening"
        elif c in LEADING:
            out.kind = "opening"
        elif c in CLOSING:
            if c == "’" and before.isalnum() and "‘" not in stack:
                out.kind = "letter"
            else:
                pop(CLOSING[c])
                out.kind = "closing"
        else:
            # on to the next character that means something
            m = _LOOK.search(text, i + 1)
            j = m.start() if m else n
            out.kind = _last_kind(text, i, j) or out.kind
            if item == "bare" and not text[i:j].isspace():
                item = "filled"
            before, i = text[j - 1], j
            continue
        before, i = c, i + 1
    if item is not None:
        # the bare mark of a list that has begun before
        out.cut = out.cut or (item == "bare" and bool(item_ends))
        if item == "bare" and not item_ends:
            out.kind = "terminal"
        out.plain_item = item == "filled" and bool(item_ends) and all(x in ("letter", "closing", "symbol") for x in item_ends)
    if in_row and rows_closed and before != "|":
        out.cut = True
    return out


def stands_alone(text: str) -> bool:
    """Whether a text without an end mark is a whole answer: a number, a word, or one of ``WHOLE``."""
    t = text.strip().lower()
    if _NUMBER.fullmatch(t) or t in WHOLE:
        return True
    words = _WORDS.findall(t)
    if len(words) != 1 or words[0] != t.strip("*_` "):
        return False
    if not _IDEOGRAPHIC.search(t):
        return t not in UNFINISHED
    return len(t) <= 2 and t[0] not in UNFINISHED_HAN and t[-1] not in "把被对从给让和与在及但"


def is_truncated(text: str) -> bool:
    """Whether a reply with letters breaks off."""
    t = _UNSEEN.sub("", text)
    if not t:
        return False
    end = parse(t)
    if end.stack or end.cut or end.kind in ("opening", "pause"):
        return True
    return end.kind == "letter" and not end.plain_item and not stands_alone(t)
