"""Best representative of each group of harvested copies by truth discovery.

Rows tied by equal usable identifiers, directly or through others, are a group.
Every value of a field is broken into units (sentences of an abstract, persons of
an author list, a DOI as one). Source reliability and votes are estimated in turn:
a unit's votes are the summed weights of the rows that state it, a well-formed
value is worth the votes of its units, the best value of each group is taken as
true, and a source's reliability is the share of its rows' units found true. This
runs until no reliability changes; fields of which a group has one well-formed value are decided
and enter the shares once. Cut-off, shortened and shuffled copies thus
vote for the parts they still have.

An abstract that several groups share is a page's filler.

Defined results: rows without rec_id, without a usable identifier, or alone in their group, form no
group; ties of votes go to the longer, then smaller text; unknown or missing
sources have the lowest weight and rank; null harvest times rank last; a group
without any well-formed value of a field has no row for it; exact repeats of a
row are one. Copies of a value are summed up before anything is joined, so
a group holding a third of all rows is small.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.functions.text import squeeze, strip
from lorewright.llm.ids import usable_doi, usable_pmid
from lorewright.llm.registry import levenshtein
from lorewright.operators.components import connected_components
from lorewright.session import cut

#: Phrases of web pages in place of a text; two of them make a value a filler, also where few groups are known.
FILLER = re.compile(
    r"cookie|download citation|terms of use|sign in|request permissions|purchase a copy|copyright notice|rights in this record"
    r"|subscri|your institution|log in|share this article|related articles|privacy policy|redistributed without|abstract (?:is )?not available"
    r"|no abstract"
)
#: Groups of different articles that bear one abstract at least to make it a filler.
SHARED_BY = 3
WORST = 1_000_000


def article_groups(rows: DataFrame) -> DataFrame:
    """``rec_id, group_id`` of the rows in groups of two or more."""
    keys = rows.where("rec_id IS NOT NULL").select(
        "rec_id",
        F.explode(
            F.array_compact(
                F.array(
                    F.concat(F.lit("d:"), usable_doi("doi")),
                    F.concat(F.lit("p:"), usable_pmid("pmid")),
                )
            )
        ).alias("k"),
    )
    # a key is named by the smallest row that bears it; two keys of one name share that row
    named = keys.join(keys.groupBy("k").agg(F.min("rec_id").alias("m")), "k")
    each = cut(named.groupBy("rec_id").agg(F.min("m").alias("m"), F.max("m").alias("n")))
    merged = connected_components(each.where("m <> n").select("m", "n"))
    label = each.join(merged.withColumnRenamed("node", "m"), "m", "left").select(
        "rec_id", F.coalesce("component", "m").alias("group_id")
    )
    several = label.groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1").select("group_id")
    return label.join(several, "group_id").select("rec_id", "group_id")


TAGS = r"<[^>]{1,200}>"
_TAG = re.compile(TAGS)
_MARKS = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_STOPPED = re.compile(r"[.!?][\"')\]”’]*$")
_LEFT_OFF = re.compile(r"(?:\.\.\.|…|\[\s*(?:\.\.\.|…)\s*\])$")
_NOBODY = re.compile(r"anonymous|unknown|et al|no author|author unknown|not available")


def _folded(text: str) -> str:
    """Lower-case letters and digits, blanks between."""
    return _MARKS.sub(" ", text.lower()).strip()


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _whole_name(name: str) -> bool:
    """Given name and surname in full, in either order."""
    parts = name.split(", ")
    words = [w for p in parts for w in p.split(" ")]
    return (
        len(parts) <= 2
        and len(words) >= 2
        and all(len(w) > 1 and w[0].isupper() and all(c.isalpha() or c in "'’-" for c in w[1:]) for w in words)
        and not _NOBODY.match(name.lower())
    )


def _person(name: str) -> str:
    surname, comma, given = name.partition(",")
    if not comma:
        given, _, surname = name.rpartition(" ")
    return f"{surname.lower()}|{given.strip().lower()}"


def abstract_claim(abstract: str | None, title: str | None) -> tuple | None:
    """(value, size, sound, units) of an abstract; None without words."""
    text = " ".join(_TAG.sub(" ", abstract or "").split())
    parts = [p for s in _SENTENCE.split(text) if (p := _folded(s))]
    folded = " ".join(parts)
    if not folded:
        return None
    words = folded.split(" ")
    # words in falling order somewhere: pairs that fall
    falls = sum(a > b for a, b in zip(words, words[1:], strict=False))
    name = _folded(" ".join(_TAG.sub(" ", title or "").split()))
    sound = (
        len(folded) >= 40
        and _STOPPED.search(text) is not None
        and not _LEFT_OFF.search(text)
        and falls > len(words) * 0.2
        and len(set(FILLER.findall(text.lower()))) < 2
        and not (abs(len(folded) - len(name)) <= 0.3 * len(folded) and levenshtein(folded, name) <= 0.3 * len(folded))
    )
    return _hash(folded), len(folded), sound, [_hash(p) for p in dict.fromkeys(parts)]


def author_claim(authors) -> tuple | None:
    """The same of an author list."""
    names = [" ".join(a.split()) for a in ([] if authors is None else authors) if a and a.strip()]
    if not names:
        return None
    keys = [_person(n) for n in names]
    sound = all(map(_whole_name, names)) and len(set(keys)) == len(keys)
    value = ";".join(sorted(keys))
    return _hash(value), len(value), sound, [_hash(k) for k in dict.fromkeys(keys)]


def _claims(rows: DataFrame) -> DataFrame:
    """``rec_id, field, value, size, sound, units``.

    ``value`` and ``units`` are 64-bit hashes of the folded value and its parts, which
    are only ever compared within a group or counted over groups; ``size`` is the folded length and ``sound`` tells well-formed values.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, doi, abstract, title, authors in zip(b["rec_id"], b["doi"], b["abstract"], b["title"], b["authors"], strict=True):
                if doi:
                    h = _hash(doi)
                    out.append((key, "doi", h, len(doi), True, [h]))
                if (c := abstract_claim(abstract, title)) is not None:
                    out.append((key, "abstract", *c))
                if (c := author_claim(authors)) is not None:
                    out.append((key, "authors", *c))
            yield pd.DataFrame(out, columns=["rec_id", "field", "value", "size", "sound", "units"])

    once = rows.where("rec_id IS NOT NULL").select("rec_id", usable_doi("doi").alias("doi"), "abstract", "title", "authors")
    return once.mapInPandas(run, "rec_id bigint, field string, value bigint, size int, sound boolean, units array<bigint>")


def without_fillers(members: DataFrame) -> DataFrame:
    """Claims with ``sound`` taken from abstracts that are fillers by their spread over the groups."""
    texts = members.where("field = 'abstract'").select("group_id", "value").distinct()
    values = texts.groupBy("value").agg(F.count("*").alias("g")).where(F.col("g") >= SHARED_BY).select("value")
    filler = values.select(F.lit("abstract").alias("field"), "value", F.lit(True).alias("filler"))
    return members.join(filler, ["field", "value"], "left").withColumn("sound", F.col("sound") & F.col("filler").isNull()).drop("filler")


def discover(members: DataFrame, max_rounds: int = 100, tolerance: float = 1e-4) -> tuple[DataFrame, DataFrame]:
    """(truths, reliabilities): ``group_id, field, value`` and ``source, reliability``."""
    # exact copies of a value from the same sources are one line with a count
    lines = cut(
        members.groupBy("group_id", "field", "value", "names").agg(
            F.count("*").alias("n"), F.first("units").alias("units"), F.max("sound").alias("sound"), F.first("size").alias("size")
        )
    )
    key = ["group_id", "field"]
    rivals = cut(lines.where("sound").groupBy(*key).agg(F.min("value").alias("value"), F.max("value").alias("other")))
    settled = rivals.where("value = other").select(*key, "value")
    open_lines = cut(lines.join(rivals.where("value <> other").select(*key), key, "left_semi"))

    def agreement(of: DataFrame, truths: DataFrame) -> DataFrame:
        true_units = truths.join(of, [*key, "value"]).groupBy(*key).agg(F.first("units").alias("true_units"))
        share = F.size(F.array_intersect("units", "true_units")) / F.size(F.array_union("units", "true_units"))
        return of.join(true_units, key).groupBy("names").agg(F.sum(share * F.col("n")).alias("share"), F.sum("n").alias("n"))

    fixed = cut(agreement(lines, settled))
    sources = lines.select(F.explode("names").alias("source")).distinct()
    reliability = cut(sources.withColumn("reliability", F.lit(0.8)))
    truths = settled
    for _ in range(max_rounds):
        # rows are weighted by the mean reliability of their sources, by the distinct sets of sources
        weights = (
            lines.select("names").distinct().select("names", F.explode("names").alias("source"))
            .join(reliability, "source").groupBy("names").agg(F.avg("reliability").alias("w"))
        )
        stated = open_lines.join(weights, "names").groupBy(*key, "value").agg(
            F.sum(F.col("n") * F.col("w")).alias("w"), F.first("units").alias("units"), F.max("sound").alias("sound"), F.first("size").alias("size")
        )
        parts = stated.select(*key, "value", "size", "w", "sound", F.explode("units").alias("unit"))
        votes = parts.groupBy(*key, "unit").agg(F.sum("w").alias("votes"))
        worth = parts.where("sound").join(votes, [*key, "unit"]).groupBy(*key, "value", "size").agg(F.round(F.sum("votes"), 6).alias("worth"))
        best = worth.groupBy(*key).agg(F.max(F.struct("worth", "size", "value")).alias("b"))
        chosen = cut(best.select(*key, F.col("b.value").alias("value")))
        agree = fixed.unionByName(agreement(open_lines, chosen))
        per_source = agree.select(F.explode("names").alias("source"), "share", "n").groupBy("source").agg(
            ((F.sum("share") + 4.0) / (F.sum("n") + 5.0)).alias("r")
        )
        before = reliability
        reliability = cut(before.join(per_source, "source", "left").select("source", F.coalesce("r", F.lit(0.8)).alias("reliability"), F.col("reliability").alias("was")))
        truths = settled.unionByName(chosen)
        change = reliability.agg(F.max(F.abs(F.col("reliability") - F.col("was"))).alias("c")).collect()[0]["c"]
        reliability = reliability.drop("was")
        if (change or 0.0) < tolerance:
            break
    else:
        raise RuntimeError("the reliabilities did not settle")
    return truths, reliability


def claims_of_groups(rows: DataFrame, trust: DataFrame, groups: DataFrame) -> DataFrame:
    """Claims of grouped rows with ``group_id``, folded source ``names`` and their best ``rank``."""
    ranks = trust.groupBy(F.lower(strip("source")).alias("name")).agg(F.min("trust_rank").alias("trust_rank"))
    names = F.array_sort(
        F.array_distinct(F.filter(F.transform("sources", lambda s: F.lower(strip(s))), lambda s: s.isNotNull() & (s != "")))
    )
    names = F.coalesce(names, F.array().cast("array<string>"))
    meta = rows.select(
        "rec_id", "harvested_at", F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(""))).alias("names")
    ).distinct()
    ranked = (
        meta.select("rec_id", F.explode("names").alias("name"))
        .join(ranks, "name", "left")
        .groupBy("rec_id")
        .agg(F.coalesce(F.min("trust_rank"), F.lit(WORST)).alias("rank"))
    )
    about = groups.join(meta, "rec_id").join(ranked, "rec_id")
    # texts stay where they are read; only hashes move. Repeats of a row are one
    return _claims(rows).dropDuplicates(["rec_id", "field"]).join(about, "rec_id")


def grouped_claims(rows: DataFrame, trust: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The claims of all grouped rows without their texts, materialised."""
    rows = rows.select("rec_id", "pmid", "doi", "title", "abstract", "authors", "sources", "harvested_at")
    return without_fillers(cut(claims_of_groups(rows, trust, groups if groups is not None else article_groups(rows))))


def survivors(rows: DataFrame, trust: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The row whose value stands for each group and field: ``group_id, field, rec_id``.

    Of the rows that state the discovered value well-formed, the one of best trust rank,
    then latest harvest, then smallest id.
    """
    members = grouped_claims(rows, trust, groups)
    truths, _ = discover(members)
    held = members.where("sound").join(truths, ["group_id", "field", "value"])
    order = F.struct(
        "rank", F.coalesce(-F.unix_micros(F.col("harvested_at").cast("timestamp")), F.lit(9223372036854775807)).alias("h"), "rec_id"
    )
    return held.groupBy("group_id", "field").agg(F.min(order).alias("o")).select("group_id", "field", F.col("o.rec_id").alias("rec_id"))


def best_records(rows: DataFrame, trust: DataFrame) -> DataFrame:
    """One record per group: ``group_id, doi, abstract, authors, sources``."""
    groups = cut(article_groups(rows))
    once = rows.dropDuplicates(["rec_id"])
    people = F.filter("authors", lambda x: x.isNotNull() & (strip(x) != ""))
    shown = once.select("rec_id", usable_doi("doi").alias("doi"), squeeze(F.regexp_replace("abstract", TAGS, " ")).alias("abstract"), people.alias("authors"))
    best = survivors(rows, trust, groups).join(shown, "rec_id").groupBy("group_id").agg(
        *[F.max(F.when(F.col("field") == f, F.col(f))).alias(f) for f in ("doi", "abstract", "authors")]
    )
    sources = (
        rows.select("rec_id", F.explode("sources").alias("s"))
        .join(groups, "rec_id")
        .where(strip("s") != "")
        .groupBy("group_id")
        .agg(F.array_sort(F.collect_set(F.lower(strip("s")))).alias("sources"))
    )
    return groups.select("group_id").distinct().join(best, "group_id", "left").join(sources, "group_id", "left")
