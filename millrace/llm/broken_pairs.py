"""Problem 3: broken prompt and response pairs, by labelling functions and an expectation-maximisation label model.

Several noisy labelling functions vote on each defect: 1 for it, -1 against it, 0 for no opinion. One of them is a
word model of declining answers, fitted on a bounded sample of rows whose label says that there is no answer. The
label model learns from the votes of all rows how far each function can be trusted, without labels, and gives every
pattern of votes a posterior. A pair keeps every defect whose posterior exceeds that defect's cutoff. Cutoffs are
validated on a bounded sample of rows, once as they are and once with each defect put into them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import label_key
from millrace.session import written

#: In order of precedence where one defect is asked for.
DEFECTS = ("empty", "copy", "refusal", "truncated", "language")
#: Posterior above which a defect counts where there is no row to validate a cutoff on.
CUTOFF = 0.5
#: Range of validated cutoffs: nothing is reported that is less likely than the first, nothing left out that is likelier than the second.
LEAST_MOST = (0.1, 0.9)
#: Rows of each label that the model of declining answers is fitted on, and rows that cutoffs are validated on: the first in hash order.
FIT_ROWS, VALIDATION_ROWS = 2000, 400
#: Log odds from which a word model votes for a declining answer; below 0 it votes against.
DECLINING = 3.0

# Answers that only hold the place of one, without punctuation.
PLACEHOLDERS = frozenset("na nd n/a n/d none null nil nan tbd todo tba xxx pending placeholder undefined empty missing blank".split())
# Words that may stand before a repeated question.
LEADS = frozenset("q question frage domanda pregunta demande a answer antwort risposta respuesta réponse reponse the is la".split())
# Phrases of declining sentences, per language.
DECLINES = {
    "en": r"(?:can ?not|can't|not able to|unable to) (?:answer|help|assist|say|respond)|(?:outside|beyond) (?:my|the|its) (?:scope|knowledge|reach)|can ?not answer|cannot (?:be )?(?:determined?|say|tell|confirm)|can't (?:answer|help|say)|(?:not|isn't) (?:specified|documented|described|covered|mentioned|stated)|never described|do(?:es)? not (?:say|specify|mention|cover|describe)|none of the (?:\w+ )?(?:pages|sections|documents|blocks|excerpts)|nothing in (?:these|the)|not enough information|silent on|will not guess|nothing can be said|\bsorry\b|unable to|would have to look into|no value is given|what remains open|a guess about|don't know|do not know",
    "it": r"non (?:posso|possiamo|sono in grado di) (?:rispondere|aiutar|dir)|fuori (?:dal mio|dalla mia|ambito|portata)|non (?:è|e'|sono) (?:determinabil|documentat|specificat|descritt|trattat)|non (?:specifican|precisan|indican)|non (?:lo )?si può (?:stabilire|dire|rispondere)|nessuna delle|servirebbero altr|tace su|non ci sono informazioni|non si documenta|mai descritt|mi dispiace|non intendo supporre|andrebbe verificat|resta aperto|non lo so",
    "de": r"kann (?:ich )?(?:dabei |hier |ihnen |dir )*nicht (?:helfen|weiterhelfen)|außerhalb (?:meines|meiner|des)|lässt sich nicht (?:beantworten|sagen|bestimmen)|sagen nicht|nirgends|fehlt jede|nicht (?:dokumentiert|beschrieben|angegeben|bekannt)|offen bleibt|leider|weiß nicht|kann (?:ich )?nicht (?:beantworten|sagen)",
    "fr": r"(?:hors|en dehors) de (?:mon|ma|mes)|ne (?:peux|peut) pas (?:aider|vous aider)|impossible de (?:répondre|dire|savoir)|ne (?:précisent|précise|disent|dit) pas|nulle part|pas (?:documenté|décrit|précisé)|reste à savoir|rien non plus|désolé|ne sais pas|ne peux pas répondre",
    "es": r"fuera de mi|no puedo (?:ayudar|contestar)|no (?:se )?pued[eo] (?:responder|decir|determinar)|no (?:indican|indica|especifican|precisan)|no (?:se describe|está documentado|está descrito)|en ninguna parte|queda abierto|tampoco hay|lo siento|no lo sé",
}
# Function words of the languages, in two lists that no word shares.
GRAMMAR = {
    "en": "the of to and by with for an from on at as or into than",
    "it": "il lo la gli di da del dello della dei delle un una uno per con nel nella dal dalla al alla sul e o l dell dall all i le che",
    "de": "der die das den dem des und oder ein eine einen einem einer von vom mit für auf zu zum zur aus bei im am durch über unter nach",
    "fr": "le la les de des et ou du au aux un une pour avec dans sur par d l qu chaque leur ses",
    "es": "el la los las de del y o un una unos unas para por con en su sus al lo",
}
STRUCTURE = {
    "en": "is it that its was has not be if when while until before after which how what why who does do can unless because so each our any every this no are will only even once",
    "it": "è non se quando quale chi come perché cosa finché dopo prima solo senza anche ha viene si sono così ogni qualsiasi nostra né mentre può dove quali questo suo proprio appena già ancora oppure soltanto affinché meno resta tra",
    "de": "ist nicht wenn wie was warum wer welche welcher sobald bis weil solange nachdem bevor wird hat sich darf man kann noch auch jede jeder unser dass schon falls damit",
    "fr": "est ne pas si quand lorsque pourquoi comment qui quelle quel après avant tant dès que sans même parce déjà peut on notre tout toute cette ce aussi dont où reste moins",
    "es": "es no se si cuando cual cuál quién cómo qué que mientras después antes hasta porque sin puede ya cada nuestra cualquier esta este ha ser está dónde desde siga",
}
# Letters, endings and beginnings typical of one language; a blank stands for the edge of a word.
SPELLING = {
    "en": ("th", "wh", "ing ", "ed ", "ck", "sh", " un", "ly "),
    "it": ("zion", "gli", "cch", "tt", "ò", "ù", "sce", "ggi", "izz", " che ", "are "),
    "de": ("ß", "sch", "ung ", "ä", "ö", "ü", "ei", "cht", "tz"),
    "fr": ("eau", "ç", "ê", "û", "œ", "eux", "oi", "ait ", "ez ", "ée", "qu"),
    "es": ("ñ", "ción", "ando ", "iendo ", "ó ", "ll", "ue", "í"),
}

# Words that no sentence ends with.
OPEN_WORDS = frozenset("the a an of to and or by with that which che di da e è il lo la un una per con o der die das und oder ein eine von mit le les de des et ou un une el los las y que en".split())
ENDS, CLOSERS, DANGLING = ".!?…。", "\"'»”’)]*_`", ",;:–—-"

_citation, _code = re.compile(r"\[[^\[\]\n]*\]"), re.compile(r"`[^`\n]*`")
_word = re.compile(r"[^\W_]+")
_sentence = re.compile(r"(?<=[.!?。])\s+|\n+")
_declines = re.compile("|".join(DECLINES.values())).search
_negation = re.compile(r"\b(?:not|no|none|nothing|never|cannot|can't|non|nessun\w*|nulla|niente|né|tace|altri|kein\w*|nicht|nirgends|pas|rien|aucun\w*|nulle|impossible|ningun\w*|nada|sorry|silent)\b")
_bullet = re.compile(r"^\s*(?:[-*+•]|\d+[.)])\s+(.*)$")
_setting = re.compile(r"^[`\"']?[\w.\-/]+[`\"']?\s*[:=]\s*\S+$")


def _owners(lists: dict[str, str]) -> dict[str, list[tuple[str, float]]]:
    of: dict[str, set[str]] = {}
    for language, words in lists.items():
        for w in words.split():
            of.setdefault(w, set()).add(language)
    return {w: [(x, 1 / len(s)) for x in sorted(s)] for w, s in of.items()}


_grammar, _structure = _owners(GRAMMAR), _owners(STRUCTURE)


def _language(words: Counter, owners: dict[str, list[tuple[str, float]]]) -> str | None:
    """The language with the most weight, if it has half as much again as the next."""
    weight: Counter = Counter()
    for w, n in words.items():
        for language, share in owners.get(w, ()):
            weight[language] += n * share
    return _clear(weight, 1.0)


def _clear(weight: Counter, least: float) -> str | None:
    top = weight.most_common(2)
    return top[0][0] if top and top[0][1] >= least and (len(top) == 1 or top[0][1] >= 1.5 * top[1][1]) else None


def _plain_words(text: str) -> tuple[list[str], bool]:
    """Lower-cased words of running text, and whether numbers stand in it: no code blocks, code spans, citations or identifiers."""
    if "```" in text:
        out, fenced = [], False
        for line in text.split("\n"):
            if line.lstrip().startswith("```"):
                fenced = not fenced
                if not fenced:
                    out.append(line.lstrip()[3:])  # text may go on behind the closing mark
            elif not fenced:
                out.append(line)
        text = "\n".join(out)
    words, numbers = [], False
    for token in _code.sub(" ", _citation.sub(" ", text)).replace("'", " ").replace("’", " ").split():
        t = token.strip(".,;:!?¿¡()[]{}\"«»“”*_>-–—…")
        if t.isalpha():
            if t.islower() or t.istitle():
                words.append(t)
        elif t.isdigit():
            numbers = True
    return " ".join(words).lower().split(), numbers


def _languages(words: list[str]) -> tuple[str | None, str | None, str | None]:
    if len(words) < 4:
        return None, None, None
    counts, text = Counter(words), f" {' '.join(words)} "
    return _language(counts, _grammar), _language(counts, _structure), _clear(Counter({k: sum(map(text.count, v)) for k, v in SPELLING.items()}), 3.0)


def _sign(x: bool) -> int:
    return 1 if x else -1


def _content(words: list[str]) -> set[str]:
    """Words that could say what a text is about: neither short nor a function word."""
    return {w for w in words if len(w) > 3 and w not in _grammar and w not in _structure}


def _coverage(words: list[str], language: str) -> float:
    """Share of words that are function words of a language."""
    own = sum(any(x == language for x, _ in (*_grammar.get(w, ()), *_structure.get(w, ()))) for w in words)
    return own / len(words)


def fit_declining(declining: list[str | None], others: list[str | None]) -> dict[str, float]:
    """Log odds of every word between answers that decline and others, words counted once an answer; of words that both kinds have about as often there is none."""
    counts = []
    for answers in (declining, others):
        seen: Counter = Counter()
        for a in answers:
            seen.update(set(_plain_words(a or "")[0]))
        counts.append(seen)
    out = {}
    for w in counts[0].keys() | counts[1].keys():
        odds = math.log((counts[0][w] + 1) / (len(declining) + 2)) - math.log((counts[1][w] + 1) / (len(others) + 2))
        if abs(odds) > 0.5:
            out[w] = round(odds, 3)
    return out


def votes(question: str | None, answer: str | None, declining: dict[str, float] | None = None) -> dict[str, list[int]]:
    """Votes of the labelling functions of each defect on one pair; null is empty text. declining: log odds from fit_declining."""
    q, a = (question or "").strip(), (answer or "").strip()
    words, asked = _word.findall(a.lower()), _word.findall(q.lower())
    bare = re.sub(r"[^\w/]+", "", a).strip("_/").lower()
    empty = [_sign(not words), _sign(not bare or bare in PLACEHOLDERS or "".join(words) in PLACEHOLDERS), _sign(len(words) <= 2 and len(a) <= 16)]
    if empty[0] > 0 or empty[1] > 0:
        return {"empty": empty, "copy": [-1, -1, -1], "refusal": [-1, -1, -1, -1, 0], "truncated": [0, 0, 0, -1, 0], "language": [0, 0, 0, 0]}

    lead = 0
    while lead < len(words) and lead < 3 and words[lead] in LEADS and words[lead] != (asked[0] if asked else ""):
        lead += 1
    body, own = words[lead:], set(asked)
    times = max(1, round(len(body) / max(1, len(asked))))
    said = set(body)
    copy = [
        _sign(bool(asked) and body == (asked * times)[: max(len(body), 1)] and len(body) >= 0.9 * len(asked)),
        _sign(bool(asked) and len(said & own) >= 0.9 * len(said | own)),
        _sign(bool(asked) and not said - own and len(said) >= 0.7 * len(own)),
    ]

    plain, numbers = _plain_words(a)
    text = _citation.sub(" ", a)
    sentences = [x for x in _sentence.split(text.lower().lstrip("> *_#-\n")) if len(_word.findall(x)) >= 2]
    opens = bool(sentences) and bool(_declines(sentences[0]))
    refusal = [
        _sign(opens),
        _sign(opens and all(_declines(x) for x in sentences[1:])),
        _sign(len(words) <= 45 and not numbers and bool(_negation.search(text.lower()))),
        _sign(len(words) <= 25 and "[" not in a and "`" not in a and not numbers and len(_content(words) & _content(asked)) <= 1 and not _content(asked) <= _content(words)),
        0,
    ]
    if declining:
        odds = sum(declining.get(w, 0.0) for w in set(plain))
        refusal[4] = 1 if odds > DECLINING else -1 if odds < 0 else 0

    lines = a.split("\n")
    fences = sum(line.lstrip().startswith("```") for line in lines)
    last = lines[-1].rstrip()
    item = _bullet.match(last)
    setting = bool(_setting.match(re.sub(r"\s*\[[^\[\]]*\]\.?$", "", item.group(1)) if item else last)) if item or len(lines) > 1 else False
    ended = last.rstrip("*_ ")
    cited = ended.endswith("]") and ended.rfind("[") >= 0
    whole = fences % 2 == 0 and (last.startswith("```") or (ended.rstrip(CLOSERS)[-1:] or "x") in ENDS or cited or (bool(item) and setting) or last.startswith("|"))
    inside = fences % 2 == 1
    truncated = [
        1 if inside else 0,
        1 if not inside and last.rfind("[") > last.rfind("]") else 0,
        1 if not inside and last.replace("```", "").count("`") % 2 else 0,
        _sign(not whole),
        1 if not inside and not whole and (ended[-1:] in DANGLING or ended.rsplit(None, 1)[-1:] and ended.rsplit(None, 1)[-1].lower() in OPEN_WORDS) else 0,
    ]

    language = [0, 0, 0, 0]
    if len(words) >= 6:
        mine = _languages(_plain_words(q)[0])
        for k, (x, y) in enumerate(zip(mine, _languages(plain), strict=True)):
            if x and y:
                language[k] = _sign(x != y)
        # the answer may be in a language that no list knows: then it lacks the function words of the question's
        agreed = {x for x in mine if x}
        if len(agreed) == 1 and sum(x is not None for x in mine) >= 2 and len(plain) >= 8:
            share = _coverage(plain, agreed.pop())
            language[3] = 1 if share < 0.12 else -1 if share > 0.25 else 0
    return {"empty": empty, "copy": copy, "refusal": refusal, "truncated": truncated, "language": language}


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of the defect for each pattern of votes (rows of -1, 0, 1), by expectation-maximisation.

    Each function has, per true state, its own chance of voting for rather than against; given the state,
    functions err independently, and keeping silent says nothing. Counts enter with a prior of a hundredth of the
    rows that trusts functions moderately, which keeps the two states from changing places. Starts from the
    majority vote; a pattern without any opinion gets the defect's share.
    """
    if not len(patterns):
        return np.zeros(0)
    score = patterns.sum(axis=1)
    pro, con = (patterns > 0).astype(float), (patterns < 0).astype(float)
    total = counts.sum()
    post = np.where(score > 0, 0.9, 0.02)
    trust = (0.15, 0.85)  # chance of a vote for, without and with the defect
    for _ in range(rounds):
        share = min(max((counts * post).sum() / total, 1 / (total + 2)), 0.5)
        log = []
        for state, weight in enumerate((1 - post, post)):
            own, prior = counts * weight, max(1.0, 0.01 * (counts * weight).sum())
            chance = (own @ pro + prior * trust[state]) / (own @ (pro + con) + prior)
            log.append(pro @ np.log(chance) + con @ np.log(1 - chance) + np.log(share if state else 1 - share))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return new


def validated_cutoff(posteriors: np.ndarray, truth: np.ndarray) -> float:
    """The cutoff within LEAST_MOST that has the best F1 on labelled rows, in the middle of the gap between the posteriors on both sides of it; CUTOFF without any positive row."""
    least, most = LEAST_MOST
    levels = np.unique(np.concatenate([[least], np.clip(posteriors, least, most), [most]]))
    best, at = 0.0, CUTOFF
    for low, high in zip(levels, levels[1:]):
        found = posteriors > (low + high) / 2
        f1 = 2 * (found & truth).sum() / max(1, found.sum() + truth.sum())
        if f1 > best + 1e-12:
            best, at = f1, float(low + high) / 2
    return at


def spoilt(pairs: list[tuple[str | None, str | None]], declined: list[str | None]) -> dict[str, list[tuple[str | None, str | None]]]:
    """Each defect put into sound pairs: nothing or a placeholder, the question itself, an answer that declines, an answer broken off within its last word, and the answer of a pair in another language."""
    out: dict[str, list] = {d: [] for d in DEFECTS}
    marks = ["", None, "N/A", " ", "TBD", "-"]
    tongue = [_clear(Counter(x for x in _languages(_plain_words(q or "")[0]) if x), 2.0) for q, _ in pairs]
    for k, (q, a) in enumerate(pairs):
        out["empty"].append((q, marks[k % len(marks)]))
        if q and len(q.split()) >= 4:
            out["copy"].append((q, q if k % 2 else f"Q: {q.lower()}"))
        if declined:
            out["refusal"].append((q, declined[k % len(declined)]))
        cut = (a or "").rstrip()[: int(len(a or "") * (0.4 + 0.1 * (k % 5)))].rstrip()
        if len(cut) > 30 and cut[-1].isalnum():
            out["truncated"].append((q, cut[:-1] if cut[-2].isalnum() else cut))
        other = next((a2 for j in range(1, len(pairs)) if tongue[k] and tongue[m := (k + j) % len(pairs)] and tongue[m] != tongue[k] and (a2 := pairs[m][1])), None)
        if other:
            out["language"].append((q, other))
    return out


def _sample(rows: DataFrame, n: int, total: int) -> list[tuple[str | None, str | None]]:
    """Question and answer of about the first n of `total` rows in hash order; no more than these reach the driver, however many tasks there are."""
    if not total:
        return []
    place = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 40))
    found = rows.withColumn("place", place).where(F.col("place") < F.lit(int(min(1.0, n / total) * (1 << 40)))).select("place", "id", "question", "answer").collect()
    return [(r.question, r.answer) for r in sorted(found, key=lambda r: (r.place, r.id, r.question or "", r.answer or ""))]


def pair_defects(examples: DataFrame, cutoff: float | None = None, fit_rows: int = FIT_ROWS, validation_rows: int = VALIDATION_ROWS) -> DataFrame:
    """id, defect, posterior: every defect of every id whose posterior exceeds its cutoff, one or more rows per broken pair.

    Refusals count only where answerable is full, in any spelling. Null question, answer or label is empty;
    repeated rows of an id count once (the row with the smallest votes, should they differ); rows without id are
    left out. The label model is fitted on the vote patterns of all rows, of which there are at most 3 to the
    number of functions of a defect. Without `cutoff` each defect has its own, validated on validation_rows rows
    and their spoilt copies; fit_rows rows of each label fit the model of declining answers.
    """
    rows = examples.where("id is not null").select("id", "question", "answer", label_key("answerable").alias("label"))
    answered = rows.where("answer is not null")
    n_none, n_full = answered.agg(F.count_if(F.col("label") == "none"), F.count_if(F.col("label") == "full")).first()
    declined = [a for _, a in _sample(answered.where("label = 'none'"), fit_rows, n_none)]
    given = _sample(answered.where("label = 'full'"), fit_rows, n_full)
    odds = fit_declining(declined, [a for _, a in given]) if declined and given else {}
    shared = examples.sparkSession.sparkContext.broadcast(odds)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            all_votes = [votes(q, a, shared.value) for q, a in zip(frame["question"], frame["answer"], strict=True)]
            out = {"id": frame["id"], "full": frame["full"]}
            for d in DEFECTS:
                out[d] = ["".join("-0+"[x + 1] for x in v[d]) for v in all_votes]
            yield pd.DataFrame(out)

    schema = "id string, full boolean, " + ", ".join(f"`{d}` string" for d in DEFECTS)
    asked = rows.select("id", "question", "answer", (F.col("label") == "full").alias("full"))
    voted = asked.mapInPandas(run, schema).groupBy("id").agg(F.min(F.struct("full", *DEFECTS)).alias("v")).select("id", "v.*")
    voted = written(voted, "pair-votes")
    seen = voted.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, DEFECTS)), F.array(*DEFECTS))).alias("defect", "pattern")).groupBy("defect", "pattern").agg(F.count("*").alias("n")).toPandas()
    sound = given[:validation_rows] if cutoff is None else []
    trials = {None: sound, **(spoilt(sound, declined) if sound else {})}
    cast = {d: ["".join("-0+"[x + 1] for x in v[d]) for v in (votes(q, a, odds) for q, a in pairs)] for d, pairs in trials.items() if d}
    whole = [votes(q, a, odds) for q, a in sound]
    table = []
    for defect in DEFECTS:
        plain = ["".join("-0+"[x + 1] for x in v[defect]) for v in whole]
        own = dict(zip(*seen[seen["defect"] == defect].sort_values("pattern")[["pattern", "n"]].to_numpy().T, strict=True)) if (seen["defect"] == defect).any() else {}
        patterns = sorted({*own, *plain, *cast.get(defect, [])})
        posts = dict(zip(patterns, fit_label_model(np.array([["-0+".index(x) - 1 for x in p] for p in patterns]), np.array([float(own.get(p, 0)) for p in patterns])), strict=True))
        least = cutoff
        if least is None:
            least = validated_cutoff(np.array([posts[p] for p in [*plain, *cast.get(defect, [])]], dtype=float), np.array([False] * len(plain) + [True] * len(cast.get(defect, [])), dtype=bool))
        table += [(defect, p, float(posts[p])) for p in own if posts[p] > least]
    out = voted.sparkSession.createDataFrame(table, "defect string, pattern string, posterior double")
    long = voted.select("id", "full", F.explode(F.map_from_arrays(F.array(*map(F.lit, DEFECTS)), F.array(*DEFECTS))).alias("defect", "pattern"))
    return long.where("full or defect <> 'refusal'").join(F.broadcast(out), ["defect", "pattern"]).select("id", "defect", F.round("posterior", 6).alias("posterior"))


def broken_pairs(examples: DataFrame, cutoff: float | None = None) -> DataFrame:
    """id, defect of every broken pair, the first of its defects in the order of DEFECTS. Edge cases as in pair_defects."""
    rank = F.array_position(F.array(*map(F.lit, DEFECTS)), F.col("defect"))
    return pair_defects(examples, cutoff).groupBy("id").agg(F.min_by("defect", rank).alias("defect"))
