"""Secret scans with a random forest against false positives, in DataFrame functions alone.

Candidates are long runs of the signs that keys are written in, and, whatever their signs, values of six or more that are
assigned to a secret's name and passwords in a URL. Each gets features of its length, its character
transitions, how much of it dictionary words cover, whether it is part of a path, and the words beside it. A random
forest, trained on labelled findings, votes. The trained trees become one column expression, so a document's candidates
are judged in the row that holds them: no join, no shuffle, nothing that a hot source could skew.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import kept_table, narrow

#: Words beside secrets. Fixed values.
NAMES = "token|secret|password|passwd|pwd|api_?key|apikey|access_?key|key|auth|bearer|credential"
#: What stands between a name and its value, up to an opening quote.
ASSIGNED = rf"(?i:{NAMES})[\"'`]?[ \t]{{0,2}}(?:=>|:=|[=:])[ \t]{{0,2}}"
#: Candidates. A quoted value that is assigned to a name goes up to its closing quote, any other up to white space, without
#: the punctuation that ends it; then passwords in a URL; then sixteen signs or more that keys are made of. The short
#: looks behind at first spare most places the long ones.
CANDIDATE = "|".join([
    r"(?<=[=:> \t\"'`])(?<=[=:>][ \t]{0,2}[\"'`]?)(?:" + "|".join([
        *[rf"(?<={ASSIGNED}{q})[^{q}\r\n]{{6,}}+(?={q})" for q in ("\"", "'", "`")],
        rf"(?<={ASSIGNED}[\"'`]?)[^\s\"'`<>]{{5,}}[^\s\"'`<>.,;:)\]}}]",
    ]) + ")",
    r"(?<=:)(?<=://[^\s/?#@:]{0,1024}:)[^\s/]+(?=@)",
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+",
])
#: Words beside what only looks like a secret. Fixed values.
BENIGN = "commit|merge|revision|rev|parent|tree|blob|sha\\d*|md5|md5sum|checksum|digest|hash|etag|uuid|guid|id|request|base64|image|version|build"
#: The end of what stands before a password in a URL; the user's name may be cut.
URL_BEFORE = r"(?:^|//)[^\s/?#@:]*:$"
#: Signs of text kept from before and after a candidate.
BEFORE, AFTER = 32, 8
#: Labelled findings that the forest is trained on at most: those with the least hashes, of either label.
SAMPLE = 10_000
TREES, DEPTH, SEED = 20, 6, 7
DICTIONARY_WORDS = 200
PLACEHOLDER = "<secret>"
FEATURES = [
    "length", "digits", "capitals", "class_changes", "digit_letter_changes", "vowel_changes", "distinct_signs", "hex_only", "dictionary",
    "path", "assigned", "quoted", "named", "number_only",
    "signs", "in_url", "benign",
]


def candidates(text: Column) -> tuple[Column, Column]:
    """The candidates of a text, and what stands before, between and after them (one more)."""
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.split(text, CANDIDATE, -1)


def features(found: Column, before: Column, after: Column, dictionary: list[str]) -> dict[str, Column]:
    """All as doubles. Shares are of the candidate's length."""
    size = F.length(found).cast("double")
    share = lambda pattern: F.regexp_count(found, F.lit(pattern)) / size
    words = "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))
    covered = (size - F.length(F.regexp_replace(F.lower(found), words, "")) if words else F.lit(0.0)) / size
    flag = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    return {
        "length": size,
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "class_changes": share(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"),
        "digit_letter_changes": share(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        "vowel_changes": share(r"(?i)(?<=[aeiouy])(?=[b-df-hj-np-tv-xz])|(?<=[b-df-hj-np-tv-xz])(?=[aeiouy])"),
        "distinct_signs": F.size(F.array_distinct(F.split(found, ""))) / size,
        "hex_only": flag(found.rlike("^[0-9a-f]+$")),
        "dictionary": covered,
        "path": flag(found.contains("/") | before.rlike(r"[/\\.]$") | after.rlike(r"^[/\\]")),
        "assigned": flag(before.rlike(r"[=:]\s?[\"']?$")),
        "quoted": flag(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")),
        "named": flag(before.rlike(rf"(?i)(?:{NAMES})\W{{0,4}}$")),
        "number_only": flag(found.rlike("^[0-9+-]+$")),
        "signs": share(r"[^A-Za-z0-9\s]"),
        "in_url": flag(before.rlike(URL_BEFORE) & after.startswith("@")),
        "benign": flag(before.rlike(rf"(?i)\b(?:{BENIGN})(?: of)?\W{{0,4}}$")),
    }


def findings(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each candidate: doc_id, its number in the document, the candidate, and what stands beside it."""
    rows = narrow(docs, doc_id=key, text=text).where("text IS NOT NULL")
    found, gaps = candidates(F.col("text"))
    rows = rows.withColumn("found", found).where(F.size("found") > 0).withColumn("gaps", gaps)
    each = rows.select("doc_id", "gaps", F.posexplode("found").alias("number", "candidate"))
    before, after = F.right(F.get("gaps", F.col("number")), F.lit(BEFORE)), F.left(F.get("gaps", F.col("number") + 1), F.lit(AFTER))
    return each.select("doc_id", "number", "candidate", before.alias("before"), after.alias("after"))


def common_words(docs: DataFrame, text: str = "text", most: int = DICTIONARY_WORDS) -> list[str]:
    """The words of four letters or more that stand in most places, counted over all texts."""
    word = F.explode(F.regexp_extract_all(F.lower(F.col(f"`{text}`")), F.lit("(?<![a-z])[a-z]{4,12}(?![a-z])"), F.lit(0)))
    counted = docs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(most).collect()]


@dataclass(frozen=True)
class Tree:
    """A vote (0 or 1), or a question about a feature with the trees for at most the threshold and above it."""

    vote: float = 0.0
    feature: str | None = None
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def column(self, values: dict[str, Column]) -> Column:
        if self.feature is None:
            return F.lit(self.vote)
        return F.when(values[self.feature] <= self.threshold, self.low.column(values)).otherwise(self.high.column(values))


@dataclass(frozen=True)
class Forest:
    trees: tuple[Tree, ...]
    dictionary: tuple[str, ...]

    def probability(self, values: dict[str, Column]) -> Column:
        """Share of the trees that take the candidate for a secret."""
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + tree.column(values)
        return total / len(self.trees) if self.trees else F.lit(0.0)



def _tree(lines: list[str]) -> Tree:
    """Reads a tree from the model's own description."""
    line = lines.pop(0).strip()
    if leaf := re.fullmatch(r"Predict: (\S+)", line):
        return Tree(vote=float(leaf[1]))
    question = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
    low = _tree(lines)
    lines.pop(0)  # Else
    return Tree(feature=FEATURES[int(question[1])], threshold=float(question[2]), low=low, high=_tree(lines))


def _trees(model: RandomForestClassificationModel) -> tuple[Tree, ...]:
    return tuple(_tree(t.toDebugString.strip().split("\n")[1:]) for t in model.trees)


def train(labelled: DataFrame, dictionary: list[str], sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest:
    """A forest from labelled findings: candidate, before, after, is_secret. At most ``sample`` of each label are used.

    Findings without a label or candidate are passed over. With one label alone every tree votes for it; without any,
    the forest is empty and takes nothing for a secret.
    """
    rows = labelled.where("is_secret IS NOT NULL AND candidate IS NOT NULL").select("candidate", "before", "after", F.col("is_secret").cast("double").alias("label"))
    rows = kept_table(rows.distinct(), "labelled")
    order = F.xxhash64("candidate", "before", "after")
    picked = rows.where("label = 1").orderBy(order).limit(sample).union(rows.where("label = 0").orderBy(order).limit(sample))
    values = features(F.col("candidate"), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")), dictionary)
    table = kept_table(picked.select("label", *[values[f].alias(f) for f in FEATURES]).coalesce(1), "sample")
    labels = [r["label"] for r in table.select("label").distinct().collect()]
    if len(labels) < 2:
        return Forest(tuple(Tree(vote=v) for v in labels), tuple(dictionary))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label")
    return Forest(_trees(forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table))), tuple(dictionary))


def scan(docs: DataFrame, forest: Forest, threshold: float = 0.5, text: str = "text", into: str = "secrets") -> DataFrame:
    """The documents with an array column of their findings: number, secret, score, start (in characters from 0), for the
    candidates whose score is above the threshold; and with what is needed to cut them out.

    Null and empty texts have none; repeated rows are judged each; an empty table gives none. All columns are kept, but
    for one named as ``into``, which is replaced.
    """
    # columns of their own, not fields of a struct: the optimizer would write out a field's expression at each use
    found, gaps = f"{into}__found", f"{into}__gaps"
    own, between = candidates(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    parts = docs.withColumn(found, own).withColumn(gaps, F.when(F.size(found) > 0, between))

    def measured(c: Column, i: Column) -> Column:
        before, after = F.right(F.get(gaps, i), F.lit(BEFORE)), F.left(F.get(gaps, i + 1), F.lit(AFTER))
        return F.struct(i.alias("number"), c.alias("secret"), before.alias("before"), after.alias("after"))

    def valued(f: Column) -> Column:
        values = features(f["secret"], f["before"], f["after"], list(forest.dictionary))
        return F.struct(f["number"].alias("number"), f["secret"].alias("secret"), *[v.alias(name) for name, v in values.items()])

    def judged(f: Column) -> Column:
        return F.struct(f["number"].alias("number"), f["secret"].alias("secret"), forest.probability({name: f[name] for name in FEATURES}).alias("score"))

    scored = F.filter(F.transform(F.transform(F.transform(found, measured), valued), judged), lambda f: f["score"] > threshold)

    def placed(f: Column) -> Column:
        before = F.array_join(F.slice(gaps, F.lit(1), f["number"] + 1), "")
        earlier = F.array_join(F.slice(found, F.lit(1), f["number"]), "")
        return F.struct(f["number"].alias("number"), f["secret"].alias("secret"), f["score"].alias("score"), (F.length(before) + F.length(earlier)).cast("bigint").alias("start"))

    return parts.withColumn(into, F.transform(scored, placed)).drop(found, gaps)


def redacted(docs: DataFrame, forest: Forest, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The documents with every secret replaced by a placeholder; texts without one stay as they are, null ones null. A
    column named __secrets is not kept."""
    into = "__secrets"
    found = scan(docs, forest, threshold, text, into)
    # from the last to the first, so that the places of those before hold
    cut = F.aggregate(
        F.reverse(into), F.col(f"`{text}`"),
        lambda t, f: F.concat(F.left(t, f["start"].cast("int")), F.lit(PLACEHOLDER), F.substring(t, f["start"].cast("int") + F.length(f["secret"]) + 1, F.length(t))),
    )
    return found.withColumn(text, cut).drop(into)


def labelled_by_form(found: DataFrame) -> DataFrame:
    """Findings with a label where their form alone settles it: keys of a known vendor's form, passwords in a URL and values
    with a digit or a sign within that are assigned to a secret's name are secrets; numbers, runs of letters alone and parts
    of paths are not. The others have none."""
    vendor = F.col("candidate").rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$")
    named = F.col("before").rlike(ASSIGNED + "[\"'`]?$")
    assigned = named & F.col("candidate").rlike(r"[0-9]|[!#$%&*+=?@^~|\\]") & ~F.col("candidate").rlike(r"\s|^[A-Za-z]+[!?]+$")
    in_url = F.col("before").rlike(URL_BEFORE) & F.col("after").startswith("@")
    plain = F.col("candidate").rlike("^(?:[0-9+-]+|[A-Za-z_-]+)$") | F.col("candidate").contains("/")
    return found.withColumn("is_secret", F.when(vendor | assigned | in_url, True).when(plain, False))
