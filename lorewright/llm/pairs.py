"""Defective prompt and response pairs by tagging clauses with a CRF.

A response is cut into clauses, each tagged answer, refusal, echo, foreign, unfinished or
void; the share of the text under each tag decides the pair's defect. An answer without a word is one void clause.
The CRF and its word rates per language are fitted on at most ``sample_rows`` rows (those of the smallest hash of
their id), labelled by seed rules that only speak on clear cases, and on the placeholders listed. What is known of an
answer's last word (never seen elsewhere, a piece of a longer word, a word that goes on
everywhere else) is counted over all rows. Tagging covers all rows.

Defined results: rows of null id are ignored; a null answer is ``empty``; a null question rules out only echo
and foreign; repeated ids count once; an empty table gives an empty result; whole
answers are read whatever their length.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.llm.crf import CRF, hashed
from lorewright.llm.registry import levenshtein
from lorewright.llm.wordlists import SETS
from lorewright.session import cut, spread

TAGS = ["answer", "refusal", "echo", "foreign", "unfinished", "void"]
LANGS = list(SETS)
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED, VOID = range(6)
#: Texts that stand for no answer; training cases.
PLACEHOLDERS = {"null", "none", "n a", "na", "nan", "nil", "tbd", "undefined", "no answer", "empty", "missing"}
#: What is known of an answer's last word: nothing odd, unknown, piece of a known word, hardly ever last.
PLAIN, UNKNOWN, PIECE, GOES_ON = range(4)

_TAGGED = re.compile(r"</?[a-zA-Z][^>]{0,200}>")
_LEAD = re.compile(r"^\s*(?:answer|question|response|antwort|frage|réponse|respuesta|pregunta|q|a)\s*[:–—-]\s*", re.I)
_CLAUSE = re.compile(r"(?<=[.!?…])[\"')\]]*\s+|\s+[-–—]\s+|\n+")
_ABBREV = re.compile(r"(?:\b[A-Za-z]|\bet al|\bcf|\bvs|\bp|\bn|\be\.g|\bi\.e|\bFig|\bDr)\.$")
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_BLANK = re.compile(r"[\s​‌‍⁠﻿]+")
#: The answerer speaks of itself or of the request, and not of the paper.
_SPEAKER = re.compile(
    r"\bi(?:'m|'d|'ll| am| cannot| can| can't| won't| will| would| do| don't| have| may| must| could| prefer| refuse| decline)\b"
    r"|\b(?:my guidelines|my remit|(?:this|the) assistant|as an? (?:ai|language model)|(?:the|your|that) request"
    r"|please (?:upload|consult|provide|rephrase|ask|contact|share)|we as an ai)\b|\bappropriate for me\b|^request not\b",
    re.I,
)
#: Articles, prepositions and conjunctions; no sentence ends in one.
DANGLING = frozenset(
    """the a an of and in to for with by from that whether as at or but than because while if between among into
    during after before which who whose was were is are has have had be de la le les des du et à au aux que qui dans
    pour par sur ou est un une der die das und zu den von des dem für mit im am ein eine einer eines einem el los las
    del y en con para por como o se un una their its his""".split()
)
_AFTER = re.compile(r"you may rephrase|thank you for understanding|anything else you would|this applies to", re.I)


def norm(text: str) -> str:
    return " ".join(w.lower() for w in _WORD.findall(text))


def plain(text: str) -> str:
    """Without mark-up, invisible blanks and lead-ins like 'Answer:'."""
    text = _BLANK.sub(" ", _TAGGED.sub(" ", text).replace("’", "'")).strip()
    while (cut := _LEAD.sub("", text)) != text:
        text = cut
    return text


def clauses(text: str) -> list[str]:
    out: list[str] = []
    at = 0
    for m in _CLAUSE.finditer(text):
        part = text[at : m.start()]
        if _ABBREV.search(part.rstrip("\"')]")) and not re.match(r"\s+[-–—]\s", m.group()):
            continue
        out.append(part.strip())
        at = m.end()
    out.append(text[at:].strip())
    return [c for c in out if _WORD.search(c)]


def quotes(evidence: str | None) -> str:
    """All strings of the evidence, folded; broken JSON is read as text."""
    if not evidence:
        return ""
    try:
        found: list[str] = []
        todo = [json.loads(evidence)]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                found.append(x)
            elif isinstance(x, dict):
                todo.extend(x.values())
            elif isinstance(x, list):
                todo.extend(x)
        evidence = " ".join(found)
    except (ValueError, RecursionError):
        pass
    return " ".join(evidence.lower().replace("’", "'").split())


_DIGITS = re.compile(r"\d+")


class Tagger:
    """Word rates per language and the trained CRF."""

    def __init__(self) -> None:
        self.rates: dict[str, tuple[float, ...]] = {}
        self.unseen: tuple[float, ...] = (0.0,) * len(SETS)
        self.crf = CRF(TAGS)
        self.ids: dict[str, int] = {}
        self.asked: dict[str, tuple] = {}

    # language

    def learn_words(self, rows: list[tuple[str | None, str | None]]) -> None:
        """Rates of words by the language of the question they answer."""
        counts = {k: Counter() for k in SETS}
        # a question is in the language most of its answers are in
        votes: dict[str, dict[str, float]] = {}
        texts = [(q, plain(a).lower()) for q, a in rows if q and a]
        for question, text in texts:
            vote = votes.setdefault(question, dict.fromkeys(SETS, 0.0))
            for w in _WORD.findall(f"{question.lower()} {text}"):
                homes = [k for k, s in SETS.items() if w in s]
                for k in homes:
                    vote[k] += 1 / len(homes) ** 2
        for question, text in texts:
            lang = max(votes[question], key=lambda k: (votes[question][k], k))
            counts[lang].update(_WORD.findall(question.lower()))
            counts[lang].update(_WORD.findall(text))
        total = {k: sum(c.values()) + 1000.0 for k, c in counts.items()}
        self.unseen = tuple(math.log(0.2 / total[k]) for k in SETS)
        for w in {w for c in counts.values() for w in c} | {w for s in SETS.values() for w in s}:
            self.rates[w] = tuple(math.log((counts[k][w] + 0.2) / total[k]) + (0.7 if w in SETS[k] else 0.0) for k in SETS)

    def language(self, words: list[str]) -> tuple[str, float]:
        """The likeliest language and the lead over the next, by the distinct words."""
        scores, get, unseen = [0.0] * len(SETS), self.rates.get, self.unseen
        for w in set(words):
            scores = [a + b for a, b in zip(scores, get(w, unseen))]  # noqa: B905
        top = max(scores)
        at = scores.index(top)
        scores[at] = -math.inf
        return LANGS[at], top - max(scores)

    # features

    def _question(self, question: str | None) -> tuple:
        """(folded words, letters, language), kept for the questions seen last."""
        key = question or ""
        if key not in self.asked:
            if len(self.asked) >= 1000:
                self.asked.clear()
            words = _WORD.findall(key.lower())
            self.asked[key] = (words, Counter(" ".join(words)), self.language(words)[0] if words else None)
        return self.asked[key]

    @staticmethod
    def _likeness(words: list[str], asked: list[str], letters: Counter) -> float:
        """How alike a clause and the question are, a few words before or after it left out; 0 below 0.7."""
        best, q = 0.0, " ".join(asked)
        extra = len(words) - len(asked)
        for part in [words] if extra <= 0 else [words, words[extra:], words[: len(asked)]] if extra <= 4 else []:
            n = " ".join(part)
            longer = max(len(n), len(q), 1)
            if abs(len(n) - len(q)) > 0.25 * len(q):
                continue
            mine = Counter(n)
            # letters the one lacks are edits at least
            if max((letters - mine).total(), (mine - letters).total()) <= 0.3 * longer:
                best = max(best, 1 - levenshtein(n, q) / longer)
        return best if best > 0.7 else 0.0

    def _cues(self, cs: list[str], question: str | None, evidence: str | None, tail: int) -> list[dict]:
        asked, letters, qlang = self._question(question)
        out = []
        for i, c in enumerate(cs):
            low = c.lower()
            words = _WORD.findall(low)
            last = i == len(cs) - 1
            mark = c.rstrip("\"')] ")
            end = "dots" if mark.endswith(("...", "…")) else "hyphen" if mark[-1:] in ("-", "‐") else mark[-1:] if mark[-1:] in (".", "!", "?") else "none"
            apart = 0
            if qlang and words:
                lang, lead = self.language(words)
                if lang != qlang:
                    apart = 2 if lead > 3 else 1 if lead > 1 else 0
            runs_on = False
            if last and end in ("none", "hyphen", "dots") and evidence:
                own = " ".join(low.split()).rstrip("-….\"' ")
                if len(own) >= 8:
                    said = quotes(evidence)
                    at = said.find(own)
                    rest = said[at + len(own) :] if at >= 0 else ""
                    runs_on = bool(rest) and (rest[0].isalnum() or (rest[:1] == " " and rest[1:2].islower()))
            out.append(
                {
                    "words": words, "last": last, "end": end, "sim": self._likeness(words, asked, letters) if asked else 0.0, "apart": apart,
                    "fw_end": bool(words) and words[-1] in DANGLING, "tail": tail if last else PLAIN, "runs_on": runs_on,
                    "after_stop": i > 0 and cs[i - 1][-1:] in (".", "!", "?") and cs[i - 1].count(" ") > 3,
                }
            )
        return out

    def _id(self, name: str) -> int:
        k = hashed([name], self.crf.bits)[0]
        if len(self.ids) < 200_000:
            self.ids[name] = k
        return k

    def _features(self, cues: list[dict]) -> list[list[int]]:
        out, known = [], self.ids.get
        for i, x in enumerate(cues):
            w = x["words"]
            text = " ".join(w)
            if not text.isalpha():
                w = _DIGITS.sub("0", text).split(" ") if text else []
            names = ["bias", f"n{min(len(w), 9)}", "first" if i == 0 else "later", "last" if x["last"] else "inner"]
            names += [f"sim{int(x['sim'] * 10)}" if x["sim"] else "sim-"] * 3
            names += [f"apart{x['apart']}"] * 3
            if x["last"] and x["end"] in ("none", "hyphen", "dots"):
                names += [f"end={x['end']}", f"fw={x['fw_end']}", f"tail{x['tail']}", f"run={x['runs_on']}"] * 2
                names += [f"stop={x['after_stop']}", "lead=" + " ".join(w[:2]), "lead1=" + " ".join(w[:1])]
                names += ["end2=" + " ".join(w[-1:])] + ["o=" + v for v in set(w)]
            names += ["w=" + v for v in set(w)]
            names += [f"b={a}_{b}" for a, b in zip(w, w[1:], strict=False)]
            out.append([k if (k := known(v)) is not None else self._id(v) for v in names])
        return out

    def _seed(self, cs: list[str], cues: list[dict]) -> list[int]:
        tags = []
        for c, x in zip(cs, cues, strict=True):
            if not x["words"] or (len(cs) == 1 and " ".join(x["words"]) in PLACEHOLDERS):
                tags.append(VOID)
            elif x["sim"] >= 0.85:
                tags.append(ECHO)
            elif _SPEAKER.search(c.replace("’", "'")) or (_AFTER.search(c) and REFUSAL in tags):
                tags.append(REFUSAL)
            elif x["apart"] == 2:
                tags.append(FOREIGN)
            elif x["last"] and (
                x["end"] in ("hyphen", "dots")
                or x["end"] == "none"
                and len(x["words"]) > 1
                and (x["fw_end"] or x["runs_on"] or x["after_stop"] or x["tail"] in (PIECE, GOES_ON) or (x["tail"] == UNKNOWN and len(x["words"]) > 4))
            ):
                tags.append(UNFINISHED)
            else:
                tags.append(ANSWER)
        return tags

    def train(self, rows: list[tuple[str | None, str | None, str | None, int]]) -> Tagger:
        """rows: (question, answer, evidence, what is known of the last word)."""
        self.learn_words([(q, a) for q, a, _, _ in rows])
        seqs, labels = [], []
        void = [(None, x, None, PLAIN) for x in ("", *sorted(PLACEHOLDERS)) for _ in range(5)]
        for q, a, e, tail in [*rows, *void]:
            cs = clauses(plain(a or "")) or [""]
            cues = self._cues(cs, q, e, tail)
            seqs.append(self._features(cues))
            labels.append(self._seed(cs, cues))
        self.crf.fit(seqs, labels)
        return self

    # decision

    def defects(self, rows: list[tuple[str | None, str | None, str | None, int]]) -> list[str | None]:
        """rows as for ``train``; they are tagged together."""
        parts = [clauses(plain(a or "")) or [""] for _, a, _, _ in rows]
        feats = [self._features(self._cues(cs, q, e, tail)) for cs, (q, _, e, tail) in zip(parts, rows, strict=True)]
        return [self._verdict(cs, tags) for cs, tags in zip(parts, self.crf.decode_all(feats), strict=True)]

    @staticmethod
    def _verdict(cs: list[str], tags: list[int]) -> str | None:
        if not any(tags):
            return None
        size = [len(c) for c in cs]
        # a short label before an explanation carries no weight of its own
        if len(cs) > 1 and cs[0][-1:] not in (".", "?", "!") and tags[0] in (ANSWER, FOREIGN, VOID) and len(_WORD.findall(cs[0])) <= 4:
            size[0] = 0
        whole = sum(size) or 1
        share = [sum(s or (len(cs) == 1) for s, t in zip(size, tags, strict=True) if t == k) / whole for k in range(len(TAGS))]
        if share[VOID] > 0.9:
            return "empty"
        if share[ECHO] > 0.9:
            return "copied_question"
        if share[REFUSAL] >= 0.5:
            return "refusal"
        if share[FOREIGN] >= 0.5:
            return "other_language"
        if tags[-1] == UNFINISHED:
            return "truncated"
        return None


def last_words(pairs: DataFrame) -> DataFrame:
    """``answer_id, tail`` of the answers without a final stop whose last word is odd, by counts over all answers.

    A word that ends very many answers without a stop is a whole word; of one that is common
    inside sentences, less than a fiftieth of the occurrences being last is odd.
    """
    word = r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*"
    said = pairs.where("answer_id IS NOT NULL AND answer IS NOT NULL").select("answer_id", F.lower("answer").alias("a"))
    is_open = ~F.col("a").rlike(r"[.!?][\"')\]]*\s*$") | F.col("a").rlike(r"(\.\.\.|…)[\"')\]]*\s*$")
    tokens = said.select(F.regexp_extract_all("a", F.lit(rf"{word}[.!?]?"), F.lit(0)).alias("t"), is_open.alias("open"))
    body = F.when(F.col("open"), F.slice("t", 1, F.greatest(F.size("t") - 1, F.lit(0)))).otherwise(F.col("t"))
    seen = tokens.select(F.explode(body).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    stopped = F.col("w").rlike(r"[.!?]$")
    known = cut(
        seen.select(F.regexp_replace("w", r"[.!?]$", "").alias("w"), F.when(stopped, F.col("n")).otherwise(0).alias("ends"), F.when(stopped, 0).otherwise(F.col("n")).alias("mid"))
        .groupBy("w").agg(F.sum("ends").alias("ends"), F.sum("mid").alias("mid"))
    )
    lasts = said.where(is_open).select("answer_id", F.regexp_extract("a", rf"({word})[^\p{{L}}\p{{N}}]*$", 1).alias("w")).where("w <> ''")
    total = pairs.agg(F.count("*").alias("rows"))
    final = lasts.groupBy("w").agg(F.count("*").alias("fin")).join(known, "w", "left").crossJoin(F.broadcast(total))  # one row
    unknown = final.where("mid IS NULL AND fin < greatest(20, rows / 300)").select("w")
    starts = known.where(F.length("w") > 2).select(F.explode(F.transform(F.sequence(F.lit(2), F.length("w") - 1), lambda i: F.substring("w", F.lit(1), i))).alias("w"))
    pieces = unknown.join(starts, "w", "left_semi").select("w", F.lit(PIECE).alias("tail"))
    going = final.where("mid >= 10 AND (ends + fin - 1) < 0.02 * (mid + ends)").select("w", F.lit(GOES_ON).alias("tail"))
    odd = unknown.select("w", F.lit(UNKNOWN).alias("tail")).unionByName(pieces).unionByName(going).groupBy("w").agg(F.max("tail").alias("tail"))
    return cut(lasts.join(odd, "w").groupBy("answer_id").agg(F.max("tail").alias("tail")))


def pair_defects(pairs: DataFrame, sample_rows: int = 12_000) -> DataFrame:
    """``answer_id, defect`` for every distinct defective answer."""
    kind = pairs.schema["answer_id"].dataType.simpleString()
    tails = last_words(pairs)
    sample = (
        pairs.select("question", "answer", "evidence", F.xxhash64("answer_id").alias("h"), "answer_id")
        .orderBy("h", "answer_id")
        .limit(sample_rows)
        .join(tails, "answer_id", "left")
        .orderBy("h", "answer_id")
        .collect()
    )
    tagger = Tagger().train([(r["question"], r["answer"], r["evidence"], r["tail"] or PLAIN) for r in sample])
    tagger.ids, tagger.asked = {}, {}
    shared = pairs.sparkSession.sparkContext.broadcast(tagger)
    rows = pairs.where("answer_id IS NOT NULL").select("answer_id", "loaded_at", "question", "answer", "evidence")
    once = spread(rows, "answer_id").groupBy("answer_id").agg(F.max(F.struct("loaded_at", "question", "answer", "evidence")).alias("x"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for b in batches:
            rows, got = list(zip(b["question"], b["answer"], b["evidence"], b["tail"].tolist(), strict=True)), []
            for a in range(0, len(rows), 1000):
                got += t.defects(rows[a : a + 1000])
            out = pd.DataFrame({"answer_id": b["answer_id"], "defect": got})
            yield out[out["defect"].notna()]

    return (
        once.join(tails, "answer_id", "left")
        .select("answer_id", "x.question", "x.answer", "x.evidence", F.coalesce("tail", F.lit(PLAIN)).alias("tail"))
        .mapInPandas(run, f"answer_id {kind}, defect string")
    )
