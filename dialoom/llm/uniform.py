"""Problem 8: one uniform form for text that looks the same (DuckDB inside Arrow partitions).

``uniform_text`` adds one column with the uniform form of a text column. Each Arrow batch is
handed to an embedded, single-threaded DuckDB that runs one SQL statement: ``nfc_normalize``,
``translate`` for forms of one character (width, compatibility ideographs, radicals, blanks,
look-alikes), ``regexp_replace`` for characters that show nothing and ``replace`` for ligatures.

``look_alike_pairs`` lists the pairs of rows whose texts are not equal by code points but have
the same uniform form. Only keys with at least two different texts are expanded, so a large
group of exact copies costs one aggregation and no pairs.

Defined cases: a null text has the uniform form null; an empty or blank one is kept by
``uniform_text`` and left out of pairs; repeated rows with the same id count once; an empty
table gives an empty result; an input column with the name of the output column is replaced.
Trailing blanks and blank line ends count as blanks like any other, one for one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.llm.letters import slices
from dialoom.session import Scratch, ship_package, spread

# Characters of another script or block with the same shape, and what they become.
LOOK_ALIKES = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M",
    "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ү": "Y",
    "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I", "Ԍ": "G", "У": "Y",
    # Greek
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian, Cherokee, phonetic letters
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "Օ": "O", "Տ": "S", "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E",
    "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ɡ": "g", "ɑ": "a",
    # marks
    "‐": "-", "‑": "-", "‚": ",", "∶": ":", "꞉": ":", "։": ":", "ǃ": "!", "⁄": "/", "∕": "/", "ʼ": "’",
}

# Letters of Lisu and Coptic, and further ones of Cherokee, with the shape of Latin letters.
LOOK_ALIKES |= dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
LOOK_ALIKES |= dict(zip("ⲎⲔⲘⲚⲞⲢⲤⲦⲬⲟⲣⲥ", "HKMNOPCTXopc"))
LOOK_ALIKES |= dict(zip("ᎠᎡᏀᎬᏞᏚ", "DRGELS"))

# Kana that look like ideographs or like the other kana. They are replaced last, when
# voicing marks have joined their kana, so that texts can be compared; for reading, those that
# stand beside other katakana and before no ideograph become katakana again.
KANA = {"ニ": "二", "ロ": "口", "ハ": "八", "カ": "力", "タ": "夕", "エ": "工", "ト": "卜", "ヘ": "へ", "ペ": "ぺ", "ベ": "べ"}

#: Characters that show nothing.
INVISIBLE = (
    "[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f"
    "\u3164\ufe00-\ufe0f\ufeff\uffa0\U0001d173-\U0001d17a\U000e0000-\U000e0fff]"
)
#: Compatibility forms that look different from what they stand for.
_VISIBLE_TAGS = ("super", "sub", "fraction", "circle", "square", "vertical", "initial", "medial", "final", "isolated")


def translation() -> tuple[str, str, list[tuple[str, str]]]:
    """From and to strings for ``translate``, and the replacements of one character by several.

    Built by rule from the Unicode data: compatibility forms that look the same, precomposed
    letters over a look-alike base, blanks and line ends.
    """
    one: dict[str, str] = {}
    many: list[tuple[str, str]] = []
    for o in [*range(0xA0, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x2F800, 0x2FA20)]:
        ch = chr(o)
        d = unicodedata.decomposition(ch)
        if unicodedata.category(ch) == "Zs":
            one[ch] = " "
            continue
        if d.startswith("<") and d[1 : d.index(">")] in _VISIBLE_TAGS:
            continue
        k = unicodedata.normalize("NFKC", ch) if d else ch
        if d and k[:1] != " " and k != unicodedata.normalize("NFC", ch):
            if len(k) == 1:
                one[ch] = LOOK_ALIKES.get(k, k)
            elif o < 0x2000 or 0xFB00 <= o <= 0xFB06:
                many.append((ch, k))
            continue
        parts = unicodedata.normalize("NFD", ch)
        if len(parts) > 1 and parts[0] in LOOK_ALIKES:
            k = unicodedata.normalize("NFC", LOOK_ALIKES[parts[0]] + parts[1:])
            if len(k) == 1:
                one[ch] = k
    one |= LOOK_ALIKES
    one |= {"\t": " ", "\v": " ", "\f": " ", "\u2800": " ", "\r": "\n", "\u0085": "\n", "\u2028": "\n", "\u2029": "\n"}
    return "".join(one), "".join(one.values()), many


def uniform_sql(column: str, table: str, more: str = "") -> str:
    """The rest of a SELECT that gives the uniform form of a column as ``t``, with ``more`` columns."""
    frm, to, many = translation()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    # both character lists are constants, so a row costs one lookup per character
    x = f"regexp_replace({column}, {quote(INVISIBLE)}, '', 'g')"
    x = f"replace(nfc_normalize({x}), chr(13) || chr(10), chr(10))"
    x = f"translate({x}, {quote(frm)}, {quote(to)})"
    ligatures = "[" + "".join(a for a, _ in many) + "]"
    chain = "u"
    for a, b in many:
        chain = f"replace({chain}, {quote(a)}, {quote(b)})"
    inner = f"(SELECT *, {x} AS u FROM {table})"
    whole = f"nfc_normalize(CASE WHEN regexp_matches(u, {quote(ligatures)}) THEN {chain} ELSE u END)"
    return f"{more}translate({whole}, {quote(''.join(KANA))}, {quote(''.join(KANA.values()))}) AS t FROM {inner}"


def readable_sql(t: str) -> str:
    """A uniform form for reading: it depends on the compared form ``t`` alone, so equal stays equal."""
    quote = lambda s: "'" + s + "'"
    x = t
    for _ in range(2):  # runs of several such letters
        for kana, other in KANA.items():
            if other >= "\u4e00":  # the hiragana among them are also a particle behind katakana
                x = f"regexp_replace({x}, {quote(f'([{{k}}]){other}([^{{h}}]|[{{l}}]|$)')}, {quote(chr(92) + '1' + kana + chr(92) + '2')}, 'g')"
            x = f"regexp_replace({x}, {quote(f'(^|[^{{h}}{{k}}]|[{{l}}]){other}([{{k}}])')}, {quote(chr(92) + '1' + kana + chr(92) + '2')}, 'g')"
    x = x.replace("{k}", "\\p{Katakana}ー").replace("{h}", "\\p{Han}").replace("{l}", "".join(c for c in KANA.values() if c >= "\u4e00"))
    return f"CASE WHEN regexp_matches({t}, '[\\p{{Katakana}}]') THEN {x} ELSE {t} END"


class Uniform:
    """The embedded SQL over one Arrow column; one per Python worker and task."""

    def __init__(self, readable: bool = False) -> None:
        import duckdb

        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB"})
        compared = f"SELECT {uniform_sql('t', 'batch', 'i, ')}"
        self.sql = f"SELECT {readable_sql('t')} AS t FROM ({compared}) ORDER BY i" if readable else f"{compared} ORDER BY i"

    def __call__(self, column: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.string())]
        for b in slices(pa.RecordBatch.from_arrays([column.cast(pa.string())], names=["t"]), 0, 4_000_000):
            batch = pa.table({"i": pa.array(range(b.num_rows), pa.int32()), "t": b.column(0)})
            self.con.register("batch", batch)
            parts.append(self.con.sql(self.sql).to_arrow_table().column("t").combine_chunks().cast(pa.string()))
            self.con.unregister("batch")
        return pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in parts])


def uniform_text(df: DataFrame, text: str = "text", out: str = "uniform_text", readable: bool = True) -> DataFrame:
    """``df`` with the column ``out`` holding the uniform form of ``text``.

    With ``readable``, katakana that look like ideographs stay katakana within words of katakana;
    without, they are ideographs, as for comparing. Both forms are equal for the same texts.
    """
    ship_package(df.sparkSession)
    base = df.drop(out) if out != text else df
    at = base.columns.index(text)
    others = [k for k, c in enumerate(base.columns) if c != out]
    schema = T.StructType([base.schema.fields[k] for k in others] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uniform = Uniform(readable)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in others], uniform(b.column(at))], names=schema.names)

    return spread(base).mapInArrow(run, schema)


def _fingerprints(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(id, k1, k2, r1, r2)``: fingerprints of 128 bits of the uniform form and of the text as it is; blank texts are left out."""
    spark = df.sparkSession
    ship_package(spark)
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType)] + [T.StructField(x, T.LongType()) for x in ("k1", "k2", "r1", "r2")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        uniform = Uniform()
        for b in batches:
            raw, ids, uni = b.column(1).to_pylist(), b.column(0), uniform(b.column(1)).to_pylist()
            rows = [i for i, u in enumerate(uni) if u and not u.isspace()]
            cols: list[list[int]] = [[], [], [], []]
            for i in rows:
                for k, s in ((0, uni[i]), (2, raw[i])):
                    d = xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass"))
                    cols[k].append(int.from_bytes(d[:8], "little", signed=True))
                    cols[k + 1].append(int.from_bytes(d[8:], "little", signed=True))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows, pa.int64())), *[pa.array(c, pa.int64()) for c in cols]], names=["id", "k1", "k2", "r1", "r2"]
            )

    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("t")).where("t IS NOT NULL AND id IS NOT NULL")
    return Scratch(spark, "look-alikes").table(spread(rows).mapInArrow(run, schema))  # read several times, made once


def look_alike_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<id>, group_id, variants, n_links)``: one row per text that reads the same as a different one.

    ``group_id`` is the smallest id of those that read the same, ``variants`` the number of their
    different texts, ``n_links`` the ids whose text differs from this one. Work in proportion to
    the rows, whatever the size of a group.
    """
    prints = _fingerprints(df, id_col, text).distinct()
    key, variant = ["k1", "k2"], ["k1", "k2", "r1", "r2"]
    by_text = prints.groupBy(*variant).agg(F.count("*").alias("same"), F.min("id").alias("least"))
    by_key = by_text.groupBy(*key).agg(F.count("*").alias("variants"), F.sum("same").alias("all"), F.min("least").alias("group_id")).where("variants > 1")
    sized = by_text.join(by_key, key).select(*variant, "group_id", "variants", (F.col("all") - F.col("same")).alias("n_links"))
    return prints.join(sized, variant).select(F.col("id").alias(id_col), "group_id", "variants", "n_links")


def look_alike_pairs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs ``(<id>_a, <id>_b)``, smaller id first, of texts that differ by code points only.

    One shuffle of (id, two fingerprints of 128 bits); the texts stay in the scan. Pairs are
    formed between different texts of one key: never within exact copies.
    """
    prints = _fingerprints(df, id_col, text)
    key, variant = ["k1", "k2"], ["k1", "k2", "r1", "r2"]
    # one row per different text of a key; a key with one text, however often, ends here
    variants = prints.select(*variant).distinct()
    several = variants.join(variants.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), key)
    a = several.select(*key, F.col("r1").alias("a1"), F.col("r2").alias("a2"))
    b = several.select(*key, F.col("r1").alias("b1"), F.col("r2").alias("b2"))
    of_texts = a.join(b, key).where("a1 < b1 OR (a1 = b1 AND a2 < b2)")
    # members are added to pairs of texts one side at a time: work in proportion to the result
    one = prints.select(*key, F.col("r1").alias("a1"), F.col("r2").alias("a2"), F.col("id").alias("x"))
    two = prints.select(*key, F.col("r1").alias("b1"), F.col("r2").alias("b2"), F.col("id").alias("y"))
    pairs = of_texts.join(one, [*key, "a1", "a2"]).join(two, [*key, "b1", "b2"]).where("x <> y")
    return pairs.select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b")).distinct()
