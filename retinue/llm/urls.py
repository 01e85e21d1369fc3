"""URL filter: rules, then naive Bayes over the words that a host name is made of."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.frames import carried
from retinue.operators.staging import settle

ALLOW, BLOCK = "allow", "block"
#: Longest word that a name is split into, in characters.
LONGEST = 20

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# Words that speak for blocking before anything is learned. A parameter of ``filter_urls``.
BLOCK_WORDS = (
    "adult ads adware bet bets betting bingo casino cheap crack escort free gambling hack jackpot keygen loan "
    "loans lottery malware nude payday pharma pharmacy phish phishing pills poker porn replica scam sex slots "
    "spam track tracker tracking viagra warez win xxx"
).split()


@dataclass(frozen=True)
class Rule:
    """``where`` is a host and the beginning of a path, as ``example.org/es/``."""

    verdict: str
    where: str

    def fits(self) -> Column:
        host, slash, path = self.where.partition("/")
        own = (F.col("host") == host) | F.col("host").endswith("." + host)
        return own & F.col("path").startswith(slash + path)


def parsed(pages: DataFrame, url: str, **keep: Column | str) -> DataFrame:
    """Host (A-Z in lower case) and path of each url, both empty without ``://``."""
    rows = carried(pages, **keep, url=F.coalesce(F.col(url), F.lit("")))
    part = lambda n: F.regexp_extract("url", _URL, n)
    host = F.translate(part(1), ascii_uppercase, ascii_lowercase)
    return rows.withColumns({"host": host, "path": part(2)}).drop("url")


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+", -1), "")


def page_words(pages: DataFrame, html: str) -> DataFrame:
    """``word``, ``n``: how often the visible text of all pages has each word that a host could hold."""
    body = F.regexp_replace(
        F.coalesce(F.col(html), F.lit("")), r"(?is)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>|&\w{1,10};", " "
    )
    words = pages.select(F.explode(F.split(F.lower(body), r"[^\p{L}0-9]+", -1)).alias("word"))
    return words.where(F.col("word").rlike(f"^[a-z0-9]{{1,{LONGEST}}}$")).groupBy("word").agg(F.count("*").alias("n"))


def best_split(name: str, starts: Sequence[int], words: Sequence[str], counts: Sequence[int], total: int) -> list[str]:
    """The most probable division of a name into words (Viterbi).

    ``words`` that occur in the name at ``starts`` have probability count / total. Any other
    string of n characters counts as a word of probability 10 / (total * 10**n). Of equally
    probable divisions the one with the longer last word wins.
    """
    known: dict[int, list[tuple[int, float]]] = {}
    for start, word, count in zip(starts, words, counts, strict=True):
        known.setdefault(start + len(word), []).append((start, log(count / total)))
    base, per_letter = log(10 / total), log(10)
    best = [0.0] + [float("-inf")] * len(name)
    back = [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        options = [(start, base - per_letter * (end - start)) for start in range(max(0, end - LONGEST), end)]
        for start, chance in options + known.get(end, []):
            if best[start] + chance > best[end]:
                best[end], back[end] = best[start] + chance, start
    out, end = [], len(name)
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def segmented(names: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """``name`` and its ``parts`` for distinct names, by the word counts ``word``, ``n``.

    Each name's substrings of up to ``LONGEST`` characters meet the word table in a join,
    so the table may be of any size. A name's own words, at most ``LONGEST`` per character,
    come back together.
    """
    length = F.char_length("name")
    starts = names.select("name", F.explode(F.sequence(F.lit(1), length)).alias("start"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(LONGEST), length - F.col("start") + 1))
    pieces = starts.select("name", "start", F.explode(sizes).alias("size")).select(
        "name", (F.col("start") - 1).alias("start"), F.substring("name", F.col("start"), F.col("size")).alias("word")
    )
    found = pieces.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("start", "word", "n")).alias("found"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for name, found in zip(batch.column("name").to_pylist(), batch.column("found").to_pylist(), strict=True):
                found = found or []
                parts.append(
                    best_split(name, [f["start"] for f in found], [f["word"] for f in found], [f["n"] for f in found], total)
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), pa.array(parts, pa.list_(pa.string()))], ["name", "parts"]
            )

    return names.join(found, "name", "left").mapInArrow(split, "name string, parts array<string>")


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    block_words: Sequence[str] = tuple(BLOCK_WORDS),
    word_odds: float = 5.0,
    smoothing: float = 2.0,
) -> DataFrame:
    """Allow or block every page by its url.

    The longest rule that fits decides. The other pages are judged by multinomial naive
    Bayes: it learns from the pages that rules decide, and adds log odds ``word_odds`` for
    each of ``block_words``, which are known beforehand. Words of a host are the most probable division of its names (:func:`segmented`), by how often the pages'
    visible text has each word; words of a path are its runs of letters and digits. A class
    c gives a word the weight count / size(c) + ``smoothing`` / all words, so that a word
    nobody has seen speaks for neither.

    Returns one row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``,
    ``score`` (log odds of block; null where a rule decides). Null urls and urls without
    ``://`` have empty host and path. A page with as much for either side, and any page
    if there is nothing to learn from, is allowed. Rows may repeat; an empty table gives
    an empty result.

    Hosts and paths are counted per distinct value first; a host with a third of all pages
    is one row from then on. Only the joins that bring scores back see single pages.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.where), r.where))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(ordered):
        rule = F.when(r.fits(), F.lit(r.where)).otherwise(rule)
        verdict = F.when(r.fits(), F.lit(r.verdict)).otherwise(verdict)
    rows = parsed(pages, url, page_id=page_id).drop("row").withColumns({"rule": rule, "verdict": verdict})

    side = lambda of: F.count(F.when(F.col("verdict") == of, 1))
    hosts = settle(rows.groupBy("host").agg(side(ALLOW).alias(ALLOW), side(BLOCK).alias(BLOCK)))
    paths = settle(rows.groupBy("path").agg(side(ALLOW).alias(ALLOW), side(BLOCK).alias(BLOCK)))
    names = hosts.select(F.explode(_tokens(F.col("host"))).alias("name")).distinct()
    seeds = pages.sparkSession.createDataFrame([(w, 1) for w in block_words], "word string, n bigint")
    words = settle(page_words(pages, html).unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n")))
    total = words.agg(F.sum("n")).first()[0] or 1
    parts = settle(segmented(names, words, total))
    # Positions keep words apart that a host has twice.
    named = hosts.select("host", F.explode(_tokens(F.col("host"))).alias("name")).join(parts, "name")
    host_words = settle(named.select("host", F.explode("parts").alias("token")))
    path_words = settle(paths.select("path", F.explode(_tokens(F.col("path"))).alias("token")))
    sums = [F.sum(ALLOW).cast("double").alias(ALLOW), F.sum(BLOCK).cast("double").alias(BLOCK)]
    learned = (
        host_words.join(hosts, "host")
        .select("token", ALLOW, BLOCK)
        .unionByName(path_words.join(paths, "path").select("token", ALLOW, BLOCK))
        .groupBy("token")
        .agg(*sums)
        .where(f"{ALLOW} + {BLOCK} > 0")
    )
    learned = settle(learned)
    size = learned.agg(*sums).first()
    pages_of = hosts.agg(*sums).first()
    allowed, blocked = size[ALLOW] or 0.0, size[BLOCK] or 0.0
    floor = smoothing / max(1.0, allowed + blocked)
    weight = lambda of, n: F.col(of) / F.lit(max(1.0, n)) + F.lit(floor)
    hint = F.lit(word_odds) * F.col("token").isin(*block_words).cast("double")
    evidence = F.log(weight(BLOCK, blocked) / weight(ALLOW, allowed))
    hints = pages.sparkSession.createDataFrame([(w, 0.0, 0.0) for w in block_words], learned.schema)
    model = settle(
        learned.unionByName(hints).groupBy("token").agg(*sums).select("token", (evidence + hint).alias("odds"))
    )
    prior = log((1 + (pages_of[BLOCK] or 0)) / (1 + (pages_of[ALLOW] or 0)))
    # Sums of doubles depend on their order; rounded, reruns agree.
    odds = lambda of, key: settle(
        of.join(model, "token").groupBy(key).agg(F.round(F.sum("odds"), 9).alias(f"{key}_odds"))
    )
    score = F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0))
    judged = (
        rows.join(odds(host_words, "host"), "host", "left")
        .join(odds(path_words, "path"), "path", "left")
        .withColumn("score", F.when(F.col("rule").isNull(), score))
    )
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(F.col("score") > 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("verdict"),
        "score",
    )
