"""Repairing text extracted from scanned pages by a noisy-channel model.

Lines are first sorted into running headers, page numbers and body. A word cut by
a line end is judged by the counts of its joined and its hyphenated form over the
whole corpus. For misrecognised characters every word type is a possible garbling
of the words that known character confusions lead back to; confusion
probabilities (re-estimated from the corpus) times n-gram likelihood decide, by
Viterbi over the candidate words of a line. All counts cover all papers.

Defined results: null and blank texts give no rows; texts that are not broken into
lines like pages only feed the counts; repeated rows of a paper are repaired
once; a line may have several findings; lines are counted from 1 at ``\\n``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.session import cut, spread

#: What is read -> what may have been printed.
CONFUSIONS = {
    "0": ["o"], "1": ["l", "i", "t"], "5": ["s"], "6": ["b", "g"], "8": ["b"], "9": ["g", "q"], "@": ["a"], "$": ["s"], "|": ["l", "i"],
    "c": ["e", "o"], "e": ["c"], "rn": ["m"], "m": ["rn", "in"], "ri": ["n"], "n": ["ri", "u"], "cl": ["d"], "d": ["cl"],
    "ii": ["u"], "u": ["ii", "n"], "h": ["b", "li"], "b": ["h"], "li": ["h"], "f": ["t"], "t": ["f", "l"], "y": ["v"], "v": ["y"],
    "q": ["g"], "g": ["q"], "l": ["i", "t"], "i": ["l"], "vv": ["w"], "w": ["vv"], "in": ["m"], "nn": ["m"], "j": ["i"],
}
#: Letters read for digits in a number.
NUMERALS = {"l": "1", "i": "1", "o": "0", "s": "5", "z": "2", "b": "6", "q": "9"}
#: Longest line a page is set with.
LONGEST_LINE = 130
FIRST_GUESS = 0.0001
#: Weight of a word seen on scanned pages against one seen elsewhere.
SCAN_WEIGHT = 0.05
#: Observations a bigram estimate is backed off with.
PRIOR = 5.0
#: Least count of a spelling that stands on the page, as it may be a rare word.
OWN_FLOOR = 0.02

#: Words after a hyphen that stands for a part left out, as in "pre- and postnatal".
SUSPENDED = {"and", "or", "to", "nor", "und", "oder", "et", "ou", "y", "o"}
HYPHENS = "-‐‑¬\u00ad"
_NUM = r"[0-9lIOoSBsqZ|]{1,6}"
_PAGE = re.compile(
    rf"(?i:\W{{0,3}}\s*(?:(?:p[a@]?[gq][ec]?|pg|p|seite|s|página|pág)\b\.?\s*)?){_NUM}(?:\s*(?:of|0f|ot|/|von|sur|de)\s*{_NUM})?\s*\W{{0,3}}"
)
_ROMAN = re.compile(r"\W{0,3}\s*[ivxl]{1,7}\s*\W{0,3}")
_WORD = re.compile(r"[^\W_@$|]")
_JOURNAL = re.compile(rf"\D{{4,}} {_NUM} \({_NUM}\) {_NUM}\s*[–—-]\s*{_NUM}$")
_RUNNING = re.compile(rf"^\S.{{2,60}}? [/I|l] (?:[^\W\d_][\w@-]*\.? ){{1,5}}{_NUM}$")
_GAP = re.compile(rf"^(?:{_NUM}\s{{2,}}\S.*|\S.*\S\s{{2,}}{_NUM})$")
_ET_AL = re.compile(r"(?i)\b[ec][tf] a[l1i]\.?$")
_TOKEN = r"[\p{L}\p{N}@$|]+(?:[-'’][\p{L}\p{N}@$|]+)*"
_WORDS = re.compile(r"(?:[^\W_]|[@$|])+(?:[-'’](?:[^\W_]|[@$|])+)*")
_LEFT = re.compile(rf"([^\W_]+(?:[-'’][^\W_]+)*)([{HYPHENS}])$")
_RIGHT = re.compile(r"^[^\W_]+(?:[-'’][^\W_]+)*")


def _folded(text: str) -> str:
    return re.sub(r"[^a-z]", "", text.lower().replace("0", "o").replace("1", "l").replace("5", "s"))


def _same_start(line: str, title: str) -> bool:
    """The line reads like the beginning of the title, a tenth of its letters misread at most."""
    a, b = _folded(line), _folded(title)[: len(_folded(line))]
    if len(a) < 6 or len(b) < len(a):
        return False
    wrong = sum(x != y for x, y in zip(a, b, strict=True))
    return wrong <= max(1, len(a) // 8)


def wrapped_regions(lines: list[str]) -> list[tuple[int, int]]:
    """Stretches (start, end) of lines broken as on a page.

    Lines too long for a page part a text. A stretch between them counts if most of its lines
    run on into a next one and they are of a length that sets prose, so even two lines are judged by themselves.
    """
    out, start = [], 0
    for i in range(len(lines) + 1):
        if i < len(lines) and len(lines[i]) <= LONGEST_LINE:
            continue
        full = [x for x in lines[start:i] if x.strip()]
        on = sum(bool(x.strip() and y.strip()) for x, y in zip(lines[start:i], lines[start + 1 : i], strict=False))
        if on * 2 >= len(full) > 1 and sum(map(len, full)) > 25 * len(full):
            out.append((start, i))
        start = i + 1
    return out


def sort_lines(text: str, title: str, authors: list[str]) -> list[tuple[int, str, str]]:
    """(line number, kind, text) with kind body, header, page or clean; clean lines are not set as on a page."""
    raw = text.split("\n")
    names = {_folded(re.split(r"[,\s]+", a.strip())[-1 if "," not in a else 0]) for a in authors if a and a.strip()}
    out, done = [], 0
    for start, end in wrapped_regions(raw):
        out += [(i + 1, "clean", raw[i]) for i in range(done, start) if raw[i].strip()]
        out += [(start + no, kind, x) for no, kind, x in _sort_region(raw[start:end], title, names)]
        done = end
    return out + [(i + 1, "clean", raw[i]) for i in range(done, len(raw)) if raw[i].strip()]


def _sort_region(raw: list[str], title: str, names: set[str]) -> list[tuple[int, str, str]]:
    lines = [x.replace("\x0c", " ").strip() for x in raw]
    n = len(lines)
    single = [bool(x) and (i + 1 == n or not lines[i + 1]) for i, x in enumerate(lines)]
    keys = Counter(_folded(x) for i, x in enumerate(lines) if single[i] and len(x) < 80)
    kinds: list[str] = []
    last = ""  # kind of the last line with content
    for i, x in enumerate(lines):
        if not x:
            kinds.append("")
            continue
        alone = single[i] and (i == 0 or not lines[i - 1] or kinds[i - 1] == "page")
        kind = "body"
        ends = i + 1 == n or not lines[i + 1]
        if ends and _PAGE.fullmatch(x) and (re.search(r"\d", x) or len(x) <= 3):
            kind = "page"
        elif ends and _ROMAN.fullmatch(x.lower()) and re.fullmatch(r"\W*[ivxl]+\W*", x.lower()):
            kind = "page"
        elif alone and len(x) <= 110:
            top = last in ("", "page") or "\x0c" in "".join(raw[max(0, i - 2) : i + 1])
            caps = x.upper() == x and re.search(r"[A-Z]{3}", x) is not None
            core = re.sub(rf"^{_NUM}\s{{2,}}|\s{{2,}}{_NUM}$", "", x)
            if (
                _JOURNAL.search(x)
                or (_RUNNING.match(x) and x[-1:] not in ".,;")
                or (_GAP.match(x) and (x[-1:] not in ".,;" or _ET_AL.search(x)))
                or (top and caps)
                or (top and _same_start(core, title) and x[-1:] not in ".!")
                or (caps and (re.search(r"\bET AL", x) or _same_start(core, title)))
                or (top and _folded(re.sub(r"(?i)\s+[ec]t\s+al\.?", "", core)) in names)
                or (top and keys[_folded(x)] > 1 and re.search(r"\d", x) and x[-1:] not in ".,;")
            ):
                kind = "header"
        kinds.append(kind)
        last = kind
    return [(i + 1, k, x) for i, (k, x) in enumerate(zip(kinds, lines, strict=True)) if k]


def page_lines(papers: DataFrame, with_text: bool = False) -> DataFrame:
    """``identifier, line_no, kind, words, left, right, mark, text``.

    ``kind`` is body, header, page or clean (a line not set as on a page); ``words`` are the folded words of
    body and clean lines. Of a body line that ends in a cut word, ``left`` and
    ``right`` are its parts and ``mark`` tells hyphen marks of their own
    ('own') from a plain hyphen in a text that has such marks ('other') or
    has not ('plain'); those parts are left out of ``words`` and ``text``, which is only there if asked for.
    """
    schema = "identifier string, line_no int, kind string, words array<string>, left string, right string, mark string, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, title, authors, text in zip(b["identifier"], b["title"], b["authors"], b["full_text"], strict=True):
                found = sort_lines(text, title or "", [] if authors is None else list(authors))
                special = any(k == "body" and (m := _LEFT.search(x)) and m.group(2) != "-" for _, k, x in found)
                body = [(no, x) for no, k, x in found if k == "body"]
                after = {no: y for (no, _), (_, y) in zip(body, body[1:], strict=False)}
                carry = 0  # characters at the start of the next body line that belong to the word before
                for no, kind, x in found:
                    if kind in ("header", "page"):
                        rows.append((key, no, kind, None, None, None, None, x if with_text else None))
                        continue
                    start, end = (carry if kind == "body" else 0), len(x)
                    left = right = mark = None
                    if kind == "body":
                        carry = 0
                        m = _LEFT.search(x)
                        nxt = _RIGHT.match(after[no]) if m and no in after else None
                        if m and nxt and m.start() >= start and nxt.group().lower() not in SUSPENDED:
                            left, right = m.group(1), nxt.group()
                            mark = "plain" if not special else "other" if m.group(2) == "-" else "own"
                            end, carry = m.start(), nxt.end()
                    rows.append((key, no, kind, _WORDS.findall(x[start:end].lower()), left, right, mark, x[start:end] if with_text else None))
            yield pd.DataFrame(rows, columns=["identifier", "line_no", "kind", "words", "left", "right", "mark", "text"])

    texts = papers.where(F.trim("full_text") != "").select("identifier", "title", "authors", "full_text")
    return spread(texts, "identifier").dropDuplicates(["identifier"]).mapInPandas(run, schema)


def word_counts(lines: DataFrame, papers: DataFrame) -> DataFrame:
    """``w, clean, scan``: counts of every word in texts without pages, and on pages."""
    heads = papers.select(F.explode(F.array("title", "abstract")).alias("text")).where("text IS NOT NULL")
    heads = heads.select(F.lit("clean").alias("k"), F.regexp_extract_all(F.lower("text"), F.lit(_TOKEN), F.lit(0)).alias("words"))
    return (
        lines.where("kind IN ('clean', 'body')").select(F.col("kind").alias("k"), "words").unionByName(heads)
        .select("k", F.explode("words").alias("w"))
        .groupBy("w")
        .agg(F.count_if(F.col("k") == "clean").alias("clean"), F.count_if(F.col("k") == "body").alias("scan"))
    )


def cut_words(lines: DataFrame, vocab: DataFrame) -> DataFrame:
    """Cut words with their verdict: ``identifier, line_no, verdict, w``, w the word as it should read."""
    parts = lines.where("left IS NOT NULL").select(
        "identifier", "line_no", "mark", F.lower("left").alias("l"), F.lower("right").alias("r")
    )
    pairs = parts.select("l", "r").distinct()
    forms = pairs.select(
        "l", "r",
        F.explode(F.array(
            F.struct(F.lit("j").alias("f"), F.concat("l", "r").alias("w")),
            F.struct(F.lit("k").alias("f"), F.concat_ws("-", "l", "r").alias("w")),
            F.struct(F.lit("l").alias("f"), F.col("l").alias("w")),
            F.struct(F.lit("r").alias("f"), F.col("r").alias("w")),
        )).alias("x"),
    ).select("l", "r", "x.*")
    n = F.coalesce(F.col("clean") + F.col("scan") * SCAN_WEIGHT, F.lit(0.0))
    counted = forms.join(vocab, "w", "left").groupBy("l", "r").agg(
        *[F.max(F.when(F.col("f") == f, n)).alias(f"n_{f}") for f in "jklr"]
    )
    # an unseen compound of two common words is likelier than an unseen word made of two common words
    whole = (F.col("n_l") >= 3) & (F.col("n_r") >= 3) & (F.length("l") >= 3) & (F.length("r") >= 4)
    by_count = (
        F.when((F.col("n_j") > 0) | (F.col("n_k") > 0), F.when(F.col("n_k") > F.col("n_j"), "keep").otherwise("join"))
        .when(whole, "keep")
        .otherwise("join")
    )
    verdict = F.when(F.col("mark") == "own", "join").when(
        (F.col("mark") == "other") & ~(F.col("n_j") > 10 * F.col("n_k") + 3), "keep"
    ).otherwise(by_count)
    return parts.join(counted, ["l", "r"]).select(
        "identifier", "line_no", verdict.alias("verdict"),
        F.when(verdict == "join", F.concat("l", "r")).otherwise(F.concat_ws("-", "l", "r")).alias("w"),
    )


def back_readings(word: str) -> list[tuple[str, str]]:
    """Words that ``word`` may be a garbling of, by one confusion or two, with the confusions."""
    single: dict[str, str] = {}
    spots = []
    for size in (1, 2):
        for i in range(len(word) - size + 1):
            for true in CONFUSIONS.get(word[i : i + size], ()):
                spots.append((i, size, true))
                single.setdefault(word[:i] + true + word[i + size :], f"{word[i : i + size]}>{true}")
    out = dict(single)
    for a in range(len(spots)):
        i, si, ti = spots[a]
        for b in range(a + 1, len(spots)):
            j, sj, tj = spots[b]
            if j >= i + si:
                cand = word[:i] + ti + word[i + si : j] + tj + word[j + sj :]
                out.setdefault(cand, f"{word[i : i + si]}>{ti} {word[j : j + sj]}>{tj}")
    out.pop(word, None)
    return list(out.items())


def number_reading(word: str) -> tuple[str, str] | None:
    """The number that a word of digits and at most as many letters like digits may be a garbling of, with the confusions."""
    letters = [c for c in word if not c.isdigit()]
    if not letters or len(letters) * 2 > len(word) or not all(c in NUMERALS for c in letters):
        return None
    return "".join(NUMERALS.get(c, c) for c in word), " ".join(f"{c}>{NUMERALS[c]}" for c in letters)


def confusion_chances(rivals: DataFrame, vocab: DataFrame, max_steps: int = 100) -> dict[str, float]:
    """Log probability of every confusion by expectation-maximisation over all words of the pages.

    rivals: ``w, scan, own, found`` of (word, confusions, count). A word's occurrences are shared out among
    itself and its rivals by count times channel; a confusion's share of what was printed that way is its chance.
    """
    pairs = [f"{a}>{t}" for a, ts in CONFUSIONS.items() for t in ts] + [f"{a}>{t}" for a, t in NUMERALS.items()]
    printed = sorted({c.split(">")[1] for c in pairs})
    times = lambda t: F.sum(F.col("scan") * (F.length("w") - F.length(F.replace("w", F.lit(t), F.lit("")))) / len(t))
    chance_of = vocab.where("scan > 0").agg(*[times(t).alias(f"n{i}") for i, t in enumerate(printed)]).collect()[0]
    room = {t: (chance_of[f"n{i}"] or 0.0) + 1.0 / FIRST_GUESS for i, t in enumerate(printed)}
    chance = dict.fromkeys(pairs, FIRST_GUESS)
    for _ in range(max_steps):
        at = F.create_map(*[F.lit(x) for c in pairs for x in (c, math.log(chance[c]))])
        x = F.transform("found", lambda f: F.struct(f["how"].alias("how"), (f["n"] * F.exp(F.aggregate(f["how"], F.lit(0.0), lambda acc, c: acc + at[c]))).alias("x")))
        shared = rivals.withColumn("xs", x).withColumn("z", F.col("own") + F.aggregate("xs", F.lit(0.0), lambda acc, f: acc + f["x"]))
        each = shared.select("scan", "z", F.explode("xs").alias("f")).select(F.explode("f.how").alias("c"), (F.col("scan") * F.col("f.x") / F.col("z")).alias("e"))
        seen = {r["c"]: r["e"] for r in each.groupBy("c").agg(F.sum("e").alias("e")).collect()}  # as long as the list of confusions
        now = {c: (seen.get(c, 0.0) + 1.0) / room[c.split(">")[1]] for c in pairs}
        change = max(abs(math.log(now[c] / chance[c])) for c in pairs)
        chance = {c: min(0.5, v) for c, v in now.items()}
        if change < 0.02:
            return {c: math.log(v) for c, v in chance.items()}
    raise RuntimeError("the chances of confusions did not settle")


def readings(vocab: DataFrame) -> DataFrame:
    """Word types of the pages with rivals: ``w, cands`` of (word, log channel, count), the word itself first.

    A word that is seen in clean text is taken to hold one confusion at most, others two, and numbers any.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for w, n, s in zip(b["w"], b["clean"], b["scan"], strict=True):
                if len(w) >= 2 and n == 0 and (number := number_reading(w)) is not None:
                    rows.append((w, n, s, number[0], number[1].split(" "), True))
                if len(w) >= 2 and any(ch.isalpha() or ch == "@" for ch in w):
                    rows += [(w, n, s, cand, h, False) for cand, how in back_readings(w) if len(h := how.split(" ")) == 1 or n == 0]
            yield pd.DataFrame(rows, columns=["w", "clean", "scan", "cand", "how", "number"])

    raw = vocab.where("scan > 0").mapInPandas(run, "w string, clean bigint, scan bigint, cand string, how array<string>, number boolean")
    weight = F.col("clean") + F.col("scan") * SCAN_WEIGHT
    known = vocab.select(F.col("w").alias("cand"), weight.alias("n")).where("n >= 1")
    # numbers are a class: each of a length is as likely as the next, but those that are known
    digits = {r["k"]: r["n"] for r in vocab.where(F.col("w").rlike("^[0-9]{1,9}$")).groupBy(F.length("w").alias("k")).agg(F.sum(weight).alias("n")).collect()}
    mass = F.lit(0.0)
    for k, n in digits.items():
        mass = F.when(F.length("cand") == k, F.lit(float(n) / (9 * 10 ** (k - 1)))).otherwise(mass)
    words = raw.where("NOT number").join(known, "cand")
    numbers = raw.where("number").join(known, "cand", "left").withColumn("n", F.greatest("n", mass)).where("n > 0")
    both = words.select("w", "clean", "scan", "cand", "how", "n").unionByName(numbers.select("w", "clean", "scan", "cand", "how", "n"))
    rivals = cut(
        both.groupBy("w").agg(F.first("clean").alias("clean"), F.first("scan").alias("scan"), F.collect_list(F.struct("cand", "how", "n")).alias("found"))
        .withColumn("own", weight)
    )
    chance = confusion_chances(rivals, vocab)
    at = F.create_map(*[F.lit(x) for c, v in chance.items() for x in (c, v)])
    # a rival is worth weighing if some context could make it win
    scored = F.transform("found", lambda f: F.struct(F.aggregate(f["how"], F.lit(0.0), lambda acc, c: acc + at[c]).alias("lp"), f["cand"].alias("cand"), f["n"].alias("n")))
    least = F.when(F.col("clean") == 0, -3.0).otherwise(-2.0)
    top = F.filter("scored", lambda f: f["lp"] + F.log(f["n"]) - F.log(F.col("own")) > least)
    return rivals.withColumn("scored", scored).withColumn("top", top).where(F.size("top") > 0).select(
        "w",
        F.concat(
            F.array(F.struct(F.col("w").alias("cand"), F.lit(0.0).alias("lp"), F.col("own").alias("n"))),
            F.transform(F.sort_array("top", asc=False), lambda x: F.struct(x["cand"].alias("cand"), x["lp"].alias("lp"), x["n"].alias("n"))),
        ).alias("cands"),
    )


def _line_words(lines: DataFrame, cuts: DataFrame) -> DataFrame:
    """``identifier, line_no, words``: the words that begin in each body line."""
    return (
        lines.where("kind = 'body'")
        .join(cuts, ["identifier", "line_no"], "left")
        .select("identifier", "line_no", F.array_compact(F.concat("words", F.array("w"))).alias("words"))
    )


def misread_words(lines: DataFrame, cuts: DataFrame, vocab: DataFrame) -> DataFrame:
    """``identifier, line_no, pos, w, fixed`` of the words decoded to something else."""
    words = cut(_line_words(lines, cuts))
    # a word travels with its two neighbours and not with its line
    at = lambda i: F.get("words", i)
    every = words.select("identifier", "line_no", "words", F.posexplode("words").alias("pos", "w")).select(
        "identifier", "line_no", "pos", "w", at(F.col("pos") - 1).alias("p"), at(F.col("pos") + 1).alias("q")
    )
    rival = readings(_with_cuts(vocab, cuts))
    spots = cut(every.join(rival, "w").select("identifier", "line_no", "pos", "w", "cands", "p", "q"))
    one = F.struct(F.lit(None).cast("string").alias("cand"), F.lit(0.0).alias("lp"), F.lit(0.0).alias("n"))
    # pairs (word before, word) whose counts the decoding of each spot needs
    after = spots.select("identifier", "line_no", "pos", F.col("cands").alias("pc"))
    step = spots.join(after.withColumn("pos", F.col("pos") + 1), ["identifier", "line_no", "pos"], "left").select(
        "*", F.coalesce("pc", F.array(F.struct(F.col("p").alias("cand"), one["lp"].alias("lp"), one["n"].alias("n")))).alias("before")
    )
    left = step.select(
        "identifier", "line_no", "pos", F.explode(F.transform("before", lambda x: x["cand"])).alias("a"), "cands"
    ).select("identifier", "line_no", "pos", "a", F.explode(F.transform("cands", lambda x: x["cand"])).alias("b"))
    right = spots.join(after.select("identifier", "line_no", (F.col("pos") - 1).alias("pos"), F.lit(True).alias("next_open")), ["identifier", "line_no", "pos"], "left").where(
        "next_open IS NULL"
    ).select("identifier", "line_no", (F.col("pos") + 1).alias("pos"), F.explode(F.transform("cands", lambda x: x["cand"])).alias("a"), F.col("q").alias("b"))
    need = left.unionByName(right).where("a IS NOT NULL AND b IS NOT NULL")
    scanned = words.select("words", F.lit(SCAN_WEIGHT).alias("u"))
    texts = scanned.unionByName(
        lines.where("kind = 'clean'").select("words", F.lit(1.0).alias("u"))
    )
    n = F.size("words")
    counts = (
        texts.where(n > 1)
        .select("u", F.explode(F.arrays_zip(F.slice("words", 1, n - 1).alias("a"), F.slice("words", 2, n - 1).alias("b"))).alias("x"))
        .groupBy(F.xxhash64("x.a", "x.b").alias("h"))  # 64 bits travel instead of two words
        .agg(F.sum("u").alias("n2"))
    )
    known = vocab.select("w", (F.col("clean") + F.col("scan") * SCAN_WEIGHT).alias("n"))
    pairs = cut(
        need.select("a", "b").distinct().withColumn("h", F.xxhash64("a", "b")).join(counts, "h", "left")
        .join(known.select(F.col("w").alias("a"), F.col("n").alias("n1")), "a", "left")
        .join(known.select(F.col("w").alias("b"), F.col("n").alias("nb")), "b", "left")
        .select("a", "b", *[F.coalesce(x, F.lit(0.0)).alias(x) for x in ("n2", "n1", "nb")])
    )
    bonus = need.join(pairs, ["a", "b"]).select(
        "identifier", "line_no", F.struct("pos", "a", "b", "n2", "n1", "nb").alias("g")
    )
    grams = bonus.groupBy("identifier", "line_no").agg(F.collect_list("g").alias("grams"))
    total = float(vocab.agg(F.sum("clean") + F.sum("scan") * SCAN_WEIGHT).collect()[0][0] or 1)
    slots = spots.groupBy("identifier", "line_no").agg(F.collect_list(F.struct("pos", "w", "p", "q", "cands")).alias("slots"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, no, sl, gr in zip(b["identifier"], b["line_no"], b["slots"], b["grams"], strict=True):
                own = {x["pos"]: x["w"] for x in sl}
                prob = {}
                for g in [] if gr is None else gr:
                    # the place under judgement is no witness of its own spelling
                    self_b, self_a = own.get(g["pos"]) == g["b"], own.get(g["pos"] - 1) == g["a"]
                    n2 = max(0.0, g["n2"] - SCAN_WEIGHT) if self_a or self_b else g["n2"]
                    n1 = max(0.0, g["n1"] - SCAN_WEIGHT) if self_a else g["n1"]
                    nb = max(OWN_FLOOR, g["nb"] - SCAN_WEIGHT) if self_b else max(g["nb"], 1e-3)
                    prob[g["pos"], g["a"], g["b"]] = (n2 + PRIOR * nb / total) / (n1 + PRIOR)
                rows += [(key, no, *x) for x in decode(list(sl), prob, total)]
            yield pd.DataFrame(rows, columns=["identifier", "line_no", "pos", "w", "fixed"])

    return slots.join(grams, ["identifier", "line_no"], "left").mapInPandas(
        run, "identifier string, line_no int, pos int, w string, fixed string"
    )


def decode(slots: list, prob: dict, total: float) -> list[tuple[int, str, str]]:
    """Viterbi over the open words of a line; returns (pos, word, decoded) where they differ."""
    slots = sorted(slots, key=lambda s: s["pos"])
    out = []
    runs: list[list] = []
    for s in slots:
        if runs and runs[-1][-1]["pos"] + 1 == s["pos"]:
            runs[-1].append(s)
        else:
            runs.append([s])
    for run in runs:
        score: dict[str, float] = {run[0]["p"]: 0.0}
        back: list[dict] = []
        for s in run:
            now: dict[str, float] = {}
            come: dict = {}
            for c in s["cands"]:
                for a, v in score.items():
                    n = max(OWN_FLOOR, c["n"] - SCAN_WEIGHT) if c["cand"] == s["w"] else c["n"]
                    lm = prob.get((s["pos"], a, c["cand"])) or n / total
                    x = v + c["lp"] + math.log(lm)
                    if c["cand"] not in now or x > now[c["cand"]]:
                        now[c["cand"]], come[c["cand"]] = x, a
            score = now
            back.append(come)
        end = run[-1]
        for c in score:
            if end["q"] is not None:
                score[c] += math.log(prob.get((end["pos"] + 1, c, end["q"])) or 1e-6)
        best = max(score, key=lambda c: (score[c], c))
        for s, come in zip(reversed(run), reversed(back), strict=True):
            if best != s["w"]:
                out.append((s["pos"], s["w"], best))
            best = come[best]
    return out


def _with_cuts(vocab: DataFrame, cuts: DataFrame) -> DataFrame:
    """Counts with the words that line ends had cut."""
    more = cuts.groupBy("w").agg(F.lit(0).cast("bigint").alias("clean"), F.count("*").alias("scan"))
    return vocab.unionByName(more).groupBy("w").agg(F.sum("clean").alias("clean"), F.sum("scan").alias("scan"))


def analyse(papers: DataFrame, with_text: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines, cut words, misread words) of all papers."""
    lines = cut(page_lines(papers, with_text))
    vocab = cut(word_counts(lines, papers.dropDuplicates(["identifier"])))
    cuts = cut(cut_words(lines, vocab))
    return lines, cuts, misread_words(lines, cuts, vocab)


def findings(papers: DataFrame) -> DataFrame:
    """``identifier, line_no, kind`` of every trace of scanning."""
    lines, cuts, wrong = analyse(papers)
    return (
        lines.where("kind IN ('header', 'page')").select("identifier", "line_no", "kind")
        .unionByName(cuts.select("identifier", "line_no", F.col("verdict").alias("kind")))
        .unionByName(wrong.select("identifier", "line_no", F.lit("misread").alias("kind")).distinct())
    )


def _respell(text: str, wrong: str, right: str) -> str:
    """The first occurrence of a word replaced, its capital kept."""

    def put(m: re.Match) -> str:
        seen = m.group()
        if len(seen) > 1 and seen.upper() == seen and seen.lower() != seen:
            return right.upper()
        return right[:1].upper() + right[1:] if seen[:1].isupper() else right

    return re.sub(rf"(?<![^\W_@$|]){re.escape(wrong)}(?![^\W_@$|])", put, text, count=1, flags=re.I)


def assemble(lines: list[tuple[int, str, str, str | None, str | None, list]]) -> str:
    """Paragraphs from (line_no, kind, text, verdict, cut word, [(wrong, right)]) of one paper, in order."""
    paragraphs: list[str] = []
    now, last, broken = "", 0, False
    for no, kind, text, verdict, word, fixes in sorted(lines, key=lambda x: x[0]):
        if kind == "clean":
            if now:
                paragraphs.append(now)
            paragraphs.append(text.strip())
            now, last, broken = "", no, False
            continue
        if kind != "body":
            broken, last = True, no
            continue
        for wrong, right in fixes:
            if word is not None and word == wrong:
                word = right
            else:
                text = _respell(text, wrong, right)
        gap = no - last > 1 and last > 0
        ended = now[-1:] in ".!?)]"
        if now and ((gap and not broken) or (broken and ended and text[:1].isupper())):
            paragraphs.append(now)
            now = ""
        text = text.strip()
        now = f"{now} {text}".strip() if text[:1] not in tuple(",.;:!?)") else now + text
        if verdict is not None and word:
            now = f"{now} {word}".strip()
        broken, last = False, no
    if now:
        paragraphs.append(now)
    return "\n\n".join(paragraphs)


def repair(papers: DataFrame) -> DataFrame:
    """``identifier, text``: every paper's text in continuous paragraphs.

    The lines of one paper are brought together; that is as much as its text.
    """
    lines, cuts, wrong = analyse(papers, True)
    fixes = wrong.groupBy("identifier", "line_no").agg(F.sort_array(F.collect_list(F.struct("pos", "w", "fixed"))).alias("fixes"))
    whole = (
        lines.select("identifier", "line_no", "kind", "text", "left", "right")
        .join(cuts, ["identifier", "line_no"], "left")
        .join(fixes, ["identifier", "line_no"], "left")
        .groupBy("identifier")
        .agg(F.collect_list(F.struct("line_no", "kind", "text", "verdict", "w", "left", "right", "fixes")).alias("lines"))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, ls in zip(b["identifier"], b["lines"], strict=True):
                rows = []
                for x in ls:
                    word = x["w"]
                    if word is not None and x["left"][:1].isupper():
                        word = word.upper() if x["left"].isupper() and len(x["left"]) > 1 else word[:1].upper() + word[1:]
                    pairs = [] if x["fixes"] is None else [(f["w"], f["fixed"]) for f in x["fixes"]]
                    if word is not None:
                        pairs = [(word, r[:1].upper() + r[1:]) if a == word.lower() and word[:1].isupper() else (a, r) for a, r in pairs]
                    rows.append((x["line_no"], x["kind"], x["text"], x["verdict"], word, pairs))
                out.append((key, assemble(rows)))
            yield pd.DataFrame(out, columns=["identifier", "text"])

    return whole.mapInPandas(run, "identifier string, text string")
