"""Problem 9: one consistent form for text that looks the same.

`visual` keeps what a reader sees: full- and half-width forms, compatibility spaces, combining sequences,
invisible characters and look-alike letters are brought to one spelling; case, digits of other shapes, accents and
line ends stay. `canonical` goes on to compatibility composed form and full case folding. Equal `visual` implies
equal `canonical`.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import block_pairs, met_once, product
from millrace.session import written

# Letters that print alike, position by position, Latin first. A larger table can be given as a file (Lookalikes.read).
LATIN_C = "ABCEHIJKMOPQSTWXYYacdehijlopqsvwxylI"
CYRILLIC = "АВСЕНІЈКМОРԚЅТԜХУҮасԁеһіјӏорԛѕѵԝхуӏӀ"
LATIN_G = "ABCEHIJKMNOPTXYZacijopuvy"
GREEK = "ΑΒϹΕΗΙͿΚΜΝΟΡΤΧΥΖαϲιϳορυνγ"
LATIN_A = "OUhnou"
ARMENIAN = "ՕՍհոօս"
LATIN_K = "ABCDEGHJKLMPSVWZ"
CHEROKEE = "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏚᏙᎳᏃ"
LATIN_X = "agcosuvwz"
LATIN_EXTENDED = "ɑɡᴄᴏꜱᴜᴠᴡᴢ"
LATIN_R = "IVXLCDMivxlcdm"
ROMAN = "ⅠⅤⅩⅬⅭⅮⅯⅰⅴⅹⅼⅽⅾⅿ"
# Ranges of default-ignorable code points.
IGNORABLE = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8"
    "\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
)
# Space separators beside the plain space.
SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"

_ignorable, _spaces = re.compile(f"[{IGNORABLE}]+"), re.compile(f"[{SPACES}]")
#: Characters that are the same in every form, whatever stands beside them.
_plain = re.compile("[\x00-\x7f\u00a1-\u00a7\u00a9\u00ab\u00ac\u00ae\u00b0\u00b1\u00b6\u00b7\u00bb\u00bf-\u00ff\u2013\u2014\u2018-\u201e]*")
_odd = re.compile(r"\S*[^\s\x00-\x7f]\S*")
_letters = re.compile("(?:[^\\W\\d_]|[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff])+")
MEMO = 200_000
#: Spellings of one large class that meet in one task.
BLOCK = 2000


def _script(ch: str) -> str:
    return unicodedata.name(ch, "").split(" ", 1)[0]


class Lookalikes:
    """Letters that print like a Latin one, and the way back into each script."""

    def __init__(self, pairs: dict[str, str]):
        self.to_latin = pairs
        self.back: dict[str, dict[str, str]] = {}
        for other, latin in pairs.items():
            self.back.setdefault(_script(other), {}).setdefault(latin, other)
        self.ambiguous = set(pairs) | set(pairs.values())

    @staticmethod
    def read(path: str) -> Lookalikes:
        """The table here and the single letters of a file in the format of the public confusables data (source ; target ; class, code points in hexadecimal) whose target is a Latin letter and which have the same case."""
        pairs = dict(_own_pairs)
        with open(path, encoding="utf-8-sig") as f:
            for line in f:
                parts = [x.split() for x in line.split("#", 1)[0].split(";")]
                if len(parts) > 1 and len(parts[0]) == len(parts[1]) == 1:
                    one, other = (chr(int(x[0], 16)) for x in parts[:2])
                    if other.isascii() and other.isalpha() and one.isalpha() and one.isupper() == other.isupper():
                        pairs.setdefault(one, other)
        return Lookalikes(pairs)

    def one_script(self, m: re.Match) -> str:
        """Look-alike letters of a word go to the script of the letters that belong to one script only: Latin, else the first of the other scripts by name, Latin where every letter is a look-alike. Words that look the same have the same such letters, so they come out the same."""
        word = m.group()
        if word.isascii():
            return word
        if not any(ch in self.ambiguous for ch in word):
            return word
        sure = {_script(ch) for ch in word if ch not in self.ambiguous}
        others = sorted(sure & self.back.keys() - {"LATIN", "SMALL", "ROMAN"})
        to = {} if "LATIN" in sure or not others else self.back[others[0]]
        latin = (self.to_latin.get(ch, ch) for ch in word)
        return "".join(to.get(ch, ch) for ch in latin)


_own_pairs = {
    other: latin
    for theirs, ours in ((CYRILLIC, LATIN_C), (GREEK, LATIN_G), (ARMENIAN, LATIN_A), (CHEROKEE, LATIN_K), (LATIN_EXTENDED, LATIN_X), (ROMAN, LATIN_R))
    for other, latin in zip(theirs, ours, strict=True)
}
LOOKALIKES = Lookalikes(_own_pairs)


def _shape(ch: str) -> str:
    kind, _, code = unicodedata.decomposition(ch).partition("> ")
    return "".join(chr(int(x, 16)) for x in code.split()) if kind in ("<wide", "<narrow") else ch


class Forms:
    """Works out (visual, canonical), once for every distinct token; one per task."""

    def __init__(self, lookalikes: Lookalikes = LOOKALIKES):
        self.lookalikes, self.memo = lookalikes, {}

    def token(self, token: str) -> tuple[str, str]:
        if (got := self.memo.get(token)) is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            one_script = self.lookalikes.one_script
            seen = unicodedata.normalize("NFC", _letters.sub(one_script, unicodedata.normalize("NFD", "".join(map(_shape, token)))))
            compat = unicodedata.normalize("NFC", _letters.sub(one_script, unicodedata.normalize("NFKD", seen)))
            got = self.memo[token] = seen, unicodedata.normalize("NFKC", compat.casefold())
        return got

    def of(self, text: str | None) -> tuple[str, str]:
        """(visual, canonical) of a text; null is empty."""
        if not text:
            return "", ""
        if text.isascii():
            return text, text.lower()
        if _plain.fullmatch(text):
            return text, text.casefold()
        text = _spaces.sub(" ", _ignorable.sub("", text))
        seen = _odd.sub(lambda m: self.token(m.group())[0], text)
        return seen, _odd.sub(lambda m: self.token(m.group())[1], text).lower()

    def of_all(self, texts: pd.Series) -> tuple[np.ndarray, list[tuple[str, str]]]:
        """For every text the place of its forms in a list that has the forms of every distinct text once."""
        at, distinct = pd.factorize(texts, use_na_sentinel=False)
        return at, [self.of(t) for t in distinct]


def canonical_text(text: str | None, forms: Forms | None = None) -> str:
    return (forms or Forms()).of(text)[1]


def _texts(documents: DataFrame, text: str, id_col: str) -> DataFrame:
    return documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))


def canonicalise(documents: DataFrame, text: str = "text", id_col: str = "doc_id", lookalikes: Lookalikes = LOOKALIKES) -> DataFrame:
    """doc_id, visual, canonical of every row with an id; null text gives empty forms, extra columns are left out. Forms are worked out once per distinct text of a batch and distinct token of a task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forms = Forms(lookalikes)
        for frame in frames:
            at, both = forms.of_all(frame["t"])
            yield pd.DataFrame({"doc_id": frame["id"], "visual": [both[k][0] for k in at], "canonical": [both[k][1] for k in at]})

    return _texts(documents, text, id_col).mapInPandas(run, "doc_id long, visual string, canonical string")


def _keys(documents: DataFrame, text: str, id_col: str, lookalikes: Lookalikes) -> DataFrame:
    """id, c: fingerprint of the canonical form, v: of the visual form, x: of the text itself. Texts don't leave the task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forms = Forms(lookalikes)
        digest = lambda s: hashlib.md5(s.encode("utf-8", "surrogatepass")).digest()
        for frame in frames:
            at, both = forms.of_all(frame["t"])
            marks = [(digest(c), digest(v)) for v, c in both]
            yield pd.DataFrame({"id": frame["id"], "c": [marks[k][0] for k in at], "v": [marks[k][1] for k in at], "x": frame["t"].map(digest)})

    return _texts(documents, text, id_col).mapInPandas(run, "id long, c binary, v binary, x binary")


def _spellings(rows: DataFrame) -> DataFrame:
    """c, v, x of every spelling in canonical classes of several spellings, with the class's number of them."""
    each = rows.select("c", "v", "x").distinct()
    return each.join(each.groupBy("c").agg(F.count("*").alias("spellings")).where("spellings > 1"), "c")


def lookalike_members(documents: DataFrame, text: str = "text", id_col: str = "doc_id", lookalikes: Lookalikes = LOOKALIKES) -> DataFrame:
    """class_id, spelling_id, doc_id of every document that has a look-alike: two documents look the same but are different strings if they share class_id and differ in spelling_id.

    Both are smallest ids, of the class and of the equal strings in it. One row per document and spelling, however
    large a class is, so all pairs can be had from it.
    """
    rows = written(_keys(documents, text, id_col, lookalikes).distinct(), "lookalike-keys")
    first = rows.groupBy("c", "v", "x").agg(F.min("id").alias("spelling_id"))
    classes = first.groupBy("c", "v").agg(F.min("spelling_id").alias("class_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(first.join(classes, ["c", "v"]), ["c", "v", "x"]).select("class_id", "spelling_id", F.col("id").alias("doc_id"))


def lookalike_pairs(documents: DataFrame, text: str = "text", id_col: str = "doc_id", lookalikes: Lookalikes = LOOKALIKES, block: int = BLOCK) -> DataFrame:
    """Pairs (doc_id_a < doc_id_b) of documents whose texts look the same but are different strings.

    Spellings (distinct texts) of one canonical form meet; the exact check that follows is equality of their visual
    form. Then every document of one spelling is paired with every document of the other. Null text is empty text,
    repeated rows of an id count once, equal strings form no pair. The form is the same for every class size; where
    a class is too large for its pairs, lookalike_members says the same in one row per document. Spellings of a
    large class meet in blocks of about `block`, their documents in blocks as well.
    """
    rows = written(_keys(documents, text, id_col, lookalikes).distinct(), "lookalike-keys")
    cut = block_pairs(_spellings(rows), "x", "spellings", block)
    a, b, col = cut.alias("a"), cut.alias("b"), F.col
    met = a.join(b, (col("a.c") == col("b.c")) & (col("a.low") == col("b.low")) & (col("a.high") == col("b.high")) & (col("a.x") < col("b.x")) & met_once("a", "b") & (col("a.v") == col("b.v")))
    links = written(met.select(col("a.x").alias("c1"), col("b.x").alias("c2")), "lookalike-links")
    told = links.select(F.col("c1").alias("c")).union(links.select("c2")).distinct()
    members = rows.select(F.col("x").alias("c"), "id").join(told, "c", "left_semi")
    pairs = product(links, members, members).where("a <> b")
    return pairs.select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b")).distinct()
