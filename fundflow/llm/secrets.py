"""Secret scans with a random forest that removes false positives.

Candidates are runs of sixteen or more of ``[A-Za-z0-9+/_-]`` (and ``=`` after them) with a
digit, or with both cases beyond the first letter; and, from six characters on, the whole
value after the name of a credential and a colon or equals sign (all characters but blanks
and quotes), and the password of a link. Each is described by its
length and kinds of characters, the likelihood of its character transitions under
those of all words of the corpus, its coverage by the corpus's dictionary, and
what labelled findings say about its path and the words before and after it. A
random forest trained on the labelled findings gives the score.

All of it is DataFrame functions and Spark's own forest; no Python runs on the
executors. What is counted over the corpus is merged map-side; its dictionary has
every word seen twice or more, the evidence of labels a documented bound.

Defined results: a NULL text has no candidates, a NULL path is an empty one;
without labelled findings every score is 0, with one kind of label every score
is that label; repeated rows are repeated candidates; an empty table gives no
rows; extra columns are ignored. Each label's findings are sampled to half of
``max_rows`` by a hash, so the forest does not depend on partitioning; weights
restore how often each label is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import plain, with_row_id, words_of, written

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
# Anchored, and without ways back: each looks at a letter once, however long the word.
_LATER_SMALL = r"^[^A-Za-z]*+[A-Za-z][^a-z]*+[a-z]"
_LATER_CAPITAL = r"^[^A-Za-z]*+[A-Za-z][^A-Z]*+[A-Z]"
# Words that name a credential.
KEYWORDS = r"(?i)(^|[^a-z])(key|token|secret|passw(or)?d|passwd|pwd|auth|bearer|credential|apikey)s?([^a-z]|$)"
_NAME = r"(?i)(?:^|[^a-z])(?:key|token|secret|passw(?:or)?d|pwd|auth|bearer|credential|apikey)s?"
_VALUE = r"(?<=\")[^\s\"]+(?=\")|(?<=')[^\s']+(?=')|(?<=`)[^\s`]+(?=`)|[^\s\"'`]*[^\s\"'`,;)}\]]"
#: A value after a name of a credential, or (second group) the password of a link.
ASSIGNED = (
    _NAME + r"[\"'`\])]*\s*(?::=|=>|==?|:)\s*[\"'`]?(" + _VALUE + r")"
    r"|://[^\s/:@]*:([^\s/@]+)@"
)
FEATURES = [
    "length", "digits", "upper", "symbols", "hex", "switches", "transition", "coverage",
    "quoted", "assigned", "keyword", "path_evidence", "near_evidence",
]
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"


def _share(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))) / F.length(text)


def candidates(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", path: str = "source"
) -> DataFrame:
    """One row per candidate: id, ``word`` (its place), ``part`` of that word, candidate, surroundings."""
    key, body, where = plain(docs, [ident, text, path])
    split = docs.select(
        key.alias("id"),
        F.coalesce(where.cast("string"), F.lit("")).alias("path"),
        F.split(F.coalesce(body, F.lit("")), r"\s+").alias("words"),
    )
    likely = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("w"))),
        lambda x: ((F.length(x["w"]) >= 16) & x["w"].rlike(CANDIDATE) & _mixed(x["w"]))
        | ((F.length(x["w"]) >= 6) & _assigned_at(x["at"], x["w"])),
    )
    found = split.select("id", "path", "words", F.explode(likely).alias("hit"))
    around = found.select(
        "id",
        "path",
        F.col("hit.at").alias("word"),
        F.col("hit.w").alias("whole"),
        F.slice("words", F.greatest(F.col("hit.at") - 2, F.lit(1)),
                F.least(F.col("hit.at"), F.lit(3))).alias("before"),
        F.slice("words", F.col("hit.at") + 2, 2).alias("after"),
    )
    around = around.select(
        "*",
        F.regexp_extract_all("whole", F.lit(CANDIDATE), F.lit(0)).alias("runs"),
        _values(F.concat(F.array_join("before", " "), F.lit(" ")), F.col("whole")).alias("values"),
    )
    mixed = F.filter("runs", lambda c: _mixed(c))
    # Runs come first and keep their places; a value that is one of them is no second candidate.
    parts = F.concat(
        F.transform("runs", lambda c: F.struct(c.alias("c"), _mixed(c).alias("ok"))),
        F.transform(
            F.filter("values", lambda c: (F.length(c) >= 6) & ~F.array_contains(mixed, c)),
            lambda c: F.struct(c.alias("c"), F.lit(True).alias("ok")),
        ),
    )
    each = around.select("*", F.posexplode(parts).alias("part", "found")).filter("found.ok")
    return each.select(
        "id", "path", "word", "whole", "before", "after", "part", F.col("found.c").alias("candidate")
    )


def _mixed(text: Column) -> Column:
    """A digit, or small and capital letters beyond the first letter."""
    return text.rlike("[0-9]") | (text.rlike(_LATER_SMALL) & text.rlike(_LATER_CAPITAL))


def _assigned_at(at: Column, word: Column) -> Column:
    """Whether a word may hold an assigned value: a sign stands in it or ends one of the two before."""
    one, two = (F.coalesce(F.try_element_at("words", at + 1 - k), F.lit("")) for k in (1, 2))
    one, two = F.when(at >= 1, one).otherwise(""), F.when(at >= 2, two).otherwise("")
    sign = word.contains("=") | word.contains(":") | one.rlike("[=:]>?[\"'`]?$")
    return sign & F.concat(two, F.lit(" "), one, F.lit(" "), word).rlike(ASSIGNED)


def _values(before: Column, whole: Column) -> Column:
    """The assigned values that end in ``whole``, the word after ``before``."""
    def found(text: Column) -> Column:
        a, b = (F.regexp_extract_all(text, F.lit(ASSIGNED), F.lit(k)) for k in (1, 2))
        return F.zip_with(a, b, lambda x, y: F.concat(x, y))

    # No value has a blank in it, so those that end in ``before`` come first.
    both = found(F.concat(before, whole))
    return F.slice(both, F.size(found(before)) + 1, F.size(both) + 1)


@dataclass(frozen=True)
class Corpus:
    """What the corpus says about words."""

    dictionary: DataFrame  # fragment: grows with the corpus; never broadcast by hint
    transitions: dict[str, float]  # two characters: log probability of the second after the first

    @classmethod
    def learn(cls, docs: DataFrame, text: str = "text", min_count: int = 2) -> Corpus:
        """Counts over all words of all documents; a word seen ``min_count`` times is in the dictionary."""
        (body,) = plain(docs, [text])
        words = docs.select(F.explode(words_of(body)).alias("w"))
        counts = written(words.groupBy("w").agg(F.count("*").alias("n")), "word-counts")
        usual = counts.filter(
            (F.length("w") >= 3) & F.col("w").rlike(r"^\p{L}+$") & (F.col("n") >= min_count)
        ).select(F.col("w").alias("fragment"))
        folded = F.regexp_replace("w", "[^a-z0-9]", "")
        pairs = counts.select(folded.alias("w"), "n").filter(F.length("w") >= 2).select(
            "n", F.explode(F.sequence(F.lit(1), F.length("w") - 1)).alias("k"), "w"
        )
        two = pairs.groupBy(F.substring("w", F.col("k"), F.lit(2)).alias("pair")).agg(
            F.sum("n").alias("n")
        )
        seen = {r["pair"]: r["n"] for r in two.collect()}  # at most 36 * 36 rows
        first: dict[str, int] = {}
        for pair, n in seen.items():
            first[pair[0]] = first.get(pair[0], 0) + n
        return cls(
            usual,
            {
                a + b: (seen.get(a + b, 0) + 1) / (first.get(a, 0) + len(_ALPHABET))
                for a in _ALPHABET
                for b in _ALPHABET
            },
        )


def _evidence(labelled: DataFrame, tokens: str, name: str, max_tokens: int) -> DataFrame:
    """Log odds of a secret for each token of labelled findings.

    The ``max_tokens`` most frequent in the sample; the odds are those of all
    labelled findings, by the weights.
    """
    each = labelled.select("label", "weight", F.explode(F.array_distinct(tokens)).alias("token"))
    a, b = (F.sum(F.when(F.col("label") == k, 1).otherwise(0)) for k in (1, 0))
    wa, wb = (F.max(F.when(F.col("label") == k, F.col("weight"))) for k in (1, 0))
    return (
        each.groupBy("token")
        .agg(a.alias("a"), b.alias("b"), wa.alias("wa"), wb.alias("wb"), F.count("*").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(max_tokens)
        .select("token", F.log((F.col("a") * F.coalesce("wa", F.lit(1.0)) + 1)
                               / (F.col("b") * F.coalesce("wb", F.lit(1.0)) + 1)).alias(name))
    )


def _sampled(labelled: DataFrame, max_rows: int) -> DataFrame:
    """Half of ``max_rows`` findings of each label, those with the smallest hash, and their ``weight``."""
    labelled = labelled.filter(F.col("label").isin(0, 1))
    total = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    half = max(1, max_rows // 2)
    place = ["candidate", "id", "word", "part"]
    each = [
        labelled.filter(F.col("label") == k)
        .orderBy(F.xxhash64(*place), *place)
        .limit(half)
        .withColumn("weight", F.lit(max(1.0, total.get(k, 0) / half)))
        for k in (0, 1)
    ]
    return each[0].unionByName(each[1])


def _mean_of(rows: DataFrame, tokens: str, table: DataFrame, name: str) -> DataFrame:
    """Add the mean of a table's values over the tokens of a row, 0 where it has none."""
    each = rows.select("row", F.explode(F.array_distinct(tokens)).alias("token"))
    found = each.join(table, "token").groupBy("row").agg(F.avg(name).alias(name))
    return rows.join(found, "row", "left").withColumn(name, F.coalesce(name, F.lit(0.0)))


def described(found: DataFrame, corpus: Corpus) -> DataFrame:
    """Candidates, numbered by ``row``, with the features that need no labels."""
    rows = written(with_row_id(found, "row"), "candidates")
    c, low = F.col("candidate"), F.lower("candidate")
    kinds = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "l"), "[A-Z]+", "u"),
                         "[0-9]+", "d"),
        "[^A-Za-z0-9]+", "s",
    )
    # Transitions that never occur are the absence of a pair in this map.
    odds = F.map_from_arrays(
        F.lit(list(corpus.transitions)), F.lit([float(p) for p in corpus.transitions.values()])
    )
    letters = F.regexp_replace(low, "[^a-z0-9]", "")
    steps = F.transform(
        F.sequence(F.lit(1), F.length(letters) - 1),
        lambda k: F.log(F.element_at(odds, letters.substr(k, F.lit(2)))),
    )
    mean = F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / F.size(steps)
    fragments = F.regexp_extract_all(F.lower(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")),
                                     F.lit("[a-z]{3,}"), F.lit(0))
    near = F.concat_ws(" ", F.array_join("before", " "),
                       F.regexp_replace(
                           F.when(c.rlike(f"^{CANDIDATE}$"), F.col("whole"))
                           .otherwise(F.replace("whole", c, F.lit(" "))), CANDIDATE, " "),
                       F.array_join("after", " "))
    rows = rows.select(
        "*",
        F.length(c).cast("double").alias("length"),
        _share(c, "[0-9]").alias("digits"),
        _share(c, "[A-Z]").alias("upper"),
        _share(c, "[^A-Za-z0-9]").alias("symbols"),
        c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex"),
        (F.length(kinds) / F.length(c)).alias("switches"),
        F.when(F.length(letters) < 2, -10.0).otherwise(mean).alias("transition"),
        fragments.alias("fragments"),
        F.col("whole").rlike("[\"'`]").cast("double").alias("quoted"),
        (F.concat_ws(" ", F.array_join("before", " "), F.regexp_extract("whole", "^[^A-Za-z0-9]*([A-Za-z_]*[:=])?", 0))
         .rlike(r"[:=]\W*$")).cast("double").alias("assigned"),
        near.rlike(KEYWORDS).cast("double").alias("keyword"),
        words_of(near).alias("near"),
        F.regexp_extract_all(F.lower("path"), F.lit(r"[\p{L}]+|[0-9]+"), F.lit(0)).alias("path_words"),
    )
    pieces = rows.select("row", F.explode("fragments").alias("fragment"))
    usual = corpus.dictionary.join(pieces.select("fragment").distinct(), "fragment", "left_semi")
    covered = (
        pieces.join(usual, "fragment")
        .groupBy("row")
        .agg(F.sum(F.length("fragment")).alias("covered"))
    )
    rows = rows.join(covered, "row", "left").withColumn(
        "coverage", F.coalesce(F.col("covered"), F.lit(0)) / F.col("length")
    )
    return written(rows.drop("covered", "fragments"), "described")


@dataclass(frozen=True)
class Scanner:
    """A forest with the tables it needs."""

    forest: RandomForestClassificationModel | float
    paths: DataFrame
    near: DataFrame

    @classmethod
    def train(
        cls,
        labelled: DataFrame,
        max_rows: int = 20_000,
        max_tokens: int = 5_000,
        trees: int = 40,
        depth: int = 6,
        seed: int = 7,
    ) -> Scanner:
        """``labelled``: described candidates with ``label`` 1 for a secret, 0 for a false positive."""
        sample = written(_sampled(labelled, max_rows), "labelled")
        paths = written(_evidence(sample, "path_words", "path_evidence", max_tokens), "paths")
        near = written(_evidence(sample, "near", "near_evidence", max_tokens), "near")
        kinds = {r["label"] for r in sample.select("label").distinct().collect()}
        if len(kinds) < 2:
            return cls(float(max(kinds, default=0)), paths, near)
        known = _mean_of(_mean_of(sample, "path_words", paths, "path_evidence"), "near", near,
                         "near_evidence")
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
            known.select(F.col("label").cast("double").alias("label"), "weight", "row", *FEATURES)
        )
        # One ordered partition of at most max_rows rows: the bootstrap follows the order.
        vectors = vectors.repartition(1).sortWithinPartitions(*FEATURES, "label")
        forest = RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight"
        )
        return cls(forest.fit(vectors.select("label", "weight", "features")), paths, near)

    def score(self, rows: DataFrame) -> DataFrame:
        """Add ``score``, the forest's share of votes for a secret."""
        if isinstance(self.forest, float):
            return rows.withColumn("score", F.lit(self.forest))
        rows = _mean_of(rows, "path_words", self.paths, "path_evidence")
        rows = _mean_of(rows, "near", self.near, "near_evidence")
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        scored = self.forest.transform(vectors)
        return scored.withColumn("score", vector_to_array("probability")[1])


def rule_labels(rows: DataFrame) -> DataFrame:
    """Findings labelled by plain rules, where a corpus comes without labels.

    A quoted value assigned to a name of a credential is a secret; addresses,
    numbers and links are false positives; others stay without a label.
    """
    c, whole = F.col("candidate"), F.col("whole")
    run = c.rlike(f"^{CANDIDATE}$")
    address = c.rlike(r"://|^www[.]|^[^@]+@[^@]+[.][A-Za-z]{2,}$")
    return rows.withColumn(
        "label",
        F.when((run & whole.rlike("@|://|www[.]")) | address | c.rlike("^[0-9+/=_-]+$"), 0)
        .when((F.col("quoted") == 1) & (F.col("assigned") == 1) & (F.col("keyword") == 1), 1),
    )
