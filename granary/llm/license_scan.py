"""License scans by a positional index of rare license words; Spark expressions only.

The templates are wordings with mandatory key phrases.  Document frequencies of
all their words over the whole corpus give inverse document frequencies; each
phrase is looked up by its rarest words (``ANCHORS`` of them), wherever these
stand in a text.  The lists of a phrase's rare words are intersected by their
positions in the phrase; at each offset that is left all words of the phrase are
verified.  A text has a template's label when each of its key phrases stands in
it.  The template's score there is the share of its weight (the sum of inverse
document frequencies over its words) that stands at its place, seen from any of
the phrases found; the text's score is the largest one.

Every phrase of every text is found, however many there are: the lookup is by
the rare words of the phrases and has no limit for each text.

Defined cases: a null text is empty and has no words and no labels; repeated
rows are scanned each; ties of rarity go to the earlier word of the phrase; an
empty table gives an empty result; further columns do not matter, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.license_texts import LICENSES
from granary.llm.storage import col, cut

UID = "uid"
#: Rarest words of a phrase that it is looked up by.
ANCHORS = 2
#: Rows of up to 100 bytes that are broadcast at most; beyond it the same join shuffles.
BROADCAST_ROWS = 100_000

#: The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
_HITS = "array<struct<pos:bigint,word:string>>"
Templates = tuple[tuple[str, str, tuple[str, ...]], ...]


def phrases_of(templates: Templates) -> list[tuple[int, int, list[str], int]]:
    """Template, number of the phrase in it, the phrase's words, where it begins in the template's words."""
    out = []
    for t, (name, text, phrases) in enumerate(templates):
        tokens = text.split()
        for k, phrase in enumerate(phrases):
            part = phrase.split()
            at = next((i for i in range(len(tokens)) if tokens[i : i + len(part)] == part), None)
            if at is None or not part:
                raise ValueError(f"the wording of {name} does not hold {phrase!r}")
            out.append((t, k, part, at))
    return out


def vocabulary_of(templates: Templates) -> list[str]:
    return sorted({w for _, text, _ in templates for w in text.split()} | {w for phrase, _ in BASE for w in phrase.split()})


def words(text: Column) -> Column:
    """The words of a text; at most the first and the last are empty.

    Letters beyond ASCII are lower-cased too, but stay beyond ASCII and so are
    words of no phrase; the sign for kelvin, which would not, is replaced first.
    """
    return F.split(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("å"))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1)


def frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """How many texts there are and how many hold each word of the vocabulary; one number a word comes back."""
    own = F.array_intersect(words(col(text)), F.array(*map(F.lit, vocabulary)))
    # an empty word stands for the text itself
    rows = docs.select(F.explode(F.concat(F.array(F.lit("")), own)).alias("word")).groupBy("word").count().collect()
    found = dict(map(tuple, rows))
    return found.pop("", 0), found


def weights(texts: int, held_by: dict[str, int], vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequencies."""
    from math import log

    return {w: log(1 + texts / max(held_by.get(w, 0), 1)) for w in vocabulary}


def rarest(phrase: list[str], idf: dict[str, float]) -> list[int]:
    """Places in the phrase of the words that it is looked up by."""
    return sorted(range(len(phrase)), key=lambda k: (-idf[phrase[k]], k))[:ANCHORS]


def hits(docs: DataFrame, text: str, key: str, vocabulary: list[str], strong: list[str]) -> DataFrame:
    """``key``, ``n_words`` and the vocabulary words with their positions, none where no rare word of a phrase stands."""

    def looked(w: Column) -> Column:
        lead = (F.get(w, F.lit(0)) == "").cast("long")
        tail = ((F.size(w) > 1) & (F.element_at(w, -1) == "")).cast("long")
        found = F.filter(F.transform(w, lambda x, i: F.when(x.isin(vocabulary), F.struct((i.cast("long") - lead).alias("pos"), x.alias("word")))), lambda x: x.isNotNull())
        some = F.when(F.exists(w, lambda x: x.isin(strong)), found).otherwise(F.array().cast(_HITS))
        return F.struct((F.size(w) - lead - tail).cast("long").alias("n_words"), some.cast(_HITS).alias("hits"))

    row = F.transform(F.array(words(col(text))), looked)[0]  # bound once, so that a text is split once
    return docs.select(col(key).alias("key"), row.alias("row")).select("key", "row.n_words", "row.hits")


def _starts(phrase: str) -> Column:
    """Positions in ``hits`` at which the phrase's words stand one after another."""
    first, *rest = phrase.split()

    def begins(h: Column, i: Column) -> Column:
        out = h["word"] == first
        for k, w in enumerate(rest, 1):
            then = F.get("hits", i + k)
            out = out & F.coalesce((then["word"] == w) & (then["pos"] == h["pos"] + k), F.lit(False))
        return out

    return F.transform(F.filter("hits", begins), lambda h: h["pos"])


def _few(df: DataFrame, name: str) -> DataFrame:
    df = cut(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def candidates(found: DataFrame, templates: Templates, idf: dict[str, float]) -> DataFrame:
    """``uid``, ``label`` and ``share`` of each template whose key phrases a text holds."""
    spark = found.sparkSession
    phrases = phrases_of(templates)
    # as many rows as the templates have words: broadcast, whatever the corpus
    posted = [(p, t, part[k], k, len(anchors)) for p, (t, _, part, _) in enumerate(phrases) for anchors in [rarest(part, idf)] for k in anchors]
    postings = F.broadcast(spark.createDataFrame(posted, "phrase int, template int, word string, place long, anchors long"))
    needed = F.broadcast(spark.createDataFrame([(p, w, k, len(part)) for p, (_, _, part, _) in enumerate(phrases) for k, w in enumerate(part)], "phrase int, word string, place long, length long"))
    begins = F.broadcast(spark.createDataFrame([(p, t, at) for p, (t, _, _, at) in enumerate(phrases)], "phrase int, template int, begin long"))
    wordings = F.broadcast(spark.createDataFrame([(t, w, k, idf[w]) for t, (_, text, _) in enumerate(templates) for k, w in enumerate(text.split())], "template int, word string, place long, idf double"))
    known = F.broadcast(spark.createDataFrame([(t, label, len(own), sum(idf[w] for w in text.split())) for t, (label, text, own) in enumerate(templates)], "template int, label string, phrases long, total double"))

    rows = found.filter(F.size("hits") > 0).select(UID, F.explode("hits").alias("h")).select(UID, "h.pos", "h.word")
    # a phrase's rare words at one offset
    met = rows.join(postings, "word").groupBy(UID, "phrase", (F.col("pos") - F.col("place")).alias("start")).agg(F.count("*").alias("n"), F.first("anchors").alias("anchors")).filter("n = anchors")
    expected = met.join(needed, "phrase").select(UID, "phrase", "start", "length", "word", (F.col("start") + F.col("place")).alias("pos"))
    stands = expected.join(rows, [UID, "word", "pos"]).groupBy(UID, "phrase", "start", "length").count().filter("count = length")
    stands = cut(stands.join(begins, "phrase").select(UID, "template", "phrase", (F.col("start") - F.col("begin")).alias("offset")), "phrases")
    whole = stands.groupBy(UID, "template").agg(F.count_distinct("phrase").alias("have")).join(known, "template").filter("have = phrases")
    whole = _few(whole.select(UID, "template", "label", "total"), "templates")
    seen = stands.select(UID, "template", "offset").distinct().join(whole, [UID, "template"]).join(wordings, "template")
    at_place = seen.select(UID, "template", "label", "total", "idf", "place", "word", (F.col("offset") + F.col("place")).alias("pos")).join(rows, [UID, "word", "pos"])
    once = at_place.groupBy(UID, "template", "place").agg(*(F.first(c).alias(c) for c in ("label", "total", "idf")))
    return once.groupBy(UID, "template").agg(F.first("label").alias("label"), F.try_divide(F.sum("idf"), F.first("total")).alias("share"))


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: Templates = LICENSES) -> DataFrame:
    """One row a document: key, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    vocabulary = vocabulary_of(templates)
    idf = weights(*frequencies(docs, text, vocabulary), vocabulary)
    parts = [part for _, _, part, _ in phrases_of(templates)] + [phrase.split() for phrase, _ in BASE]
    strong = sorted({part[rarest(part, idf)[0]] for part in parts})
    found = cut(hits(docs, text, key, vocabulary, strong).withColumn(UID, F.monotonically_increasing_id()), "license-words")
    more = candidates(found, templates, idf).groupBy(UID).agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    starts = [_starts(phrase) for phrase, _ in BASE]
    places = F.concat(*starts)
    none = F.lit(None).cast("string")
    base = F.array_compact(F.array(*(F.when(F.size(s) > 0, F.lit(label)).otherwise(none) for s, (_, label) in zip(starts, BASE, strict=True))))
    own = found.select(UID, "key", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"), base.alias("base"))
    score = F.when(F.col("more").isNotNull(), F.least(F.col("share"), F.lit(1.0))).when(F.col("n_base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return own.join(_few(more, "labels"), UID, "left").select(
        F.col("key").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.round(score, 9).alias("score"),
    )


def sql(docs: str, templates: Templates = LICENSES) -> str:
    """The scan by DuckDB, which looks for every phrase at every word."""

    def listed(words: list[str]) -> str:
        return ", ".join(f"'{w}'" for w in words)

    labels = ", ".join(f"({t}, '{label}', {len(own)})" for t, (label, _, own) in enumerate(templates))
    wordings = ", ".join(f"({t}, {k}, '{w}')" for t, (_, text, _) in enumerate(templates) for k, w in enumerate(text.split()))
    phrases = ", ".join(f"({p}, {t}, {at}, '{' '.join(part)}')" for p, (t, _, part, at) in enumerate(phrases_of(templates)))
    base = ", ".join(f"('{phrase}', '{label}')" for phrase, label in BASE)
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {docs}),
u AS (SELECT doc_id, word, pos FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d) WHERE word IN ({listed(vocabulary_of(templates))})),
labels AS (SELECT * FROM (VALUES {labels}) AS v(template, label, phrases)),
wordings AS (SELECT * FROM (VALUES {wordings}) AS v(template, place, word)),
phrases AS (SELECT phrase, template, begins, string_split(said, ' ') AS p FROM (VALUES {phrases}) AS v(phrase, template, begins, said)),
bases AS (SELECT string_split(said, ' ') AS p, label FROM (VALUES {base}) AS v(said, label)),
base AS (SELECT d.doc_id, label, pos FROM d JOIN u ON d.doc_id = u.doc_id JOIN bases ON u.word = p[1] WHERE w[pos + 1 : pos + len(p)] = p),
based AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM base GROUP BY doc_id),
idf AS (SELECT word, ln(1 + (SELECT count(*) FROM d) / greatest(count(DISTINCT doc_id), 1)) AS idf FROM (SELECT DISTINCT word FROM wordings) LEFT JOIN u USING (word) GROUP BY word),
stands AS (SELECT d.doc_id, template, phrase, pos - begins AS shift FROM d JOIN u ON d.doc_id = u.doc_id JOIN phrases ON u.word = p[1] WHERE w[pos + 1 : pos + len(p)] = p),
whole AS (SELECT doc_id, template, label FROM stands JOIN labels USING (template) GROUP BY doc_id, template, label, phrases HAVING count(DISTINCT phrase) = phrases),
met AS (SELECT DISTINCT s.doc_id, s.template, label, x.place, x.word FROM stands s JOIN whole USING (doc_id, template) JOIN wordings x ON x.template = s.template JOIN u ON u.doc_id = s.doc_id AND u.word = x.word AND u.pos = s.shift + x.place),
totals AS (SELECT template, sum(idf) AS total FROM wordings JOIN idf USING (word) GROUP BY template),
shares AS (SELECT doc_id, template, label, sum(idf) / nullif(any_value(total), 0) AS share FROM met JOIN idf USING (word) JOIN totals USING (template) GROUP BY doc_id, template, label),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM shares GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
 coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, m.labels))), ','), '') AS labels,
 round(CASE WHEN m.labels IS NOT NULL THEN least(share, 1.0) WHEN n_base > 0 THEN 0.5 ELSE 0.0 END, 9) AS score
FROM d LEFT JOIN based b ON d.doc_id = b.doc_id LEFT JOIN more m ON d.doc_id = m.doc_id"""
