"""Labelled findings for the secret scan: lines whose kind says what their long value is.

There is no table of reviewed findings, so lines are made: of secrets (keys, tokens, passwords, with a name beside them, in
prose, in a URL) and of what only looks like one (commits, checksums, UUIDs, images in base64, paths, numbers, long words,
settings that name a secret without holding one). A label comes from the kind of line alone, not from the features
that the forest sees; findings are cut out of the lines by the scan's own candidates. Give ``secret_scan.train``
reviewed findings where there are any.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import secret_scan
from tallyline.llm.frames import kept_table

#: Lines that are made: the findings that the forest is trained on at most.
LINES = 6000
# Fixed values.
NAMES = ["token", "secret", "password", "api_key", "access_key", "auth", "credential", "apikey", "client_secret", "TOKEN", "API_KEY", "passwd"]
WORDS = [
    "the", "service", "returned", "window", "garden", "yesterday", "morning", "configure", "without", "between", "mountain", "people", "under", "station",
    "quickly", "remember", "required", "optional", "disabled", "language", "important", "together", "different", "question", "water", "children",
]


def lines(spark: SparkSession, n: int = LINES, seed: int = 1) -> DataFrame:
    """doc_id, text, value (the part that is or looks like a secret) and is_secret. Every kind is about as frequent."""
    h = F.col("h")

    def hexed(size: int, at: int = 1) -> Column:
        return F.substring(h, at, size)

    def number(salt: str) -> Column:
        return F.crc32(F.concat(F.lit(salt), h))

    def one_of(words: list[str], salt: str) -> Column:
        return F.element_at(F.array(*[F.lit(w) for w in words]), (number(salt) % len(words)).cast("int") + 1)

    base = spark.range(n).select(F.col("id").alias("doc_id"), F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 512).alias("h"))
    base = base.withColumns({
        "name": one_of(NAMES, "name"), "word": one_of(WORDS, "word"), "other": one_of(WORDS, "other"), "third": one_of(WORDS, "third"), "quote": one_of(["\"", "'"], "quote"),
        "code": F.regexp_replace(F.base64(F.unhex(h)), "[\r\n=]", ""), "kind": number("kind"),
        "size": F.when(number("size") % 3 == 0, hexed(32)).when(number("size") % 3 == 1, hexed(40)).otherwise(hexed(64)),
    })
    name, word, other, third, quote, size = (F.col(c) for c in ("name", "word", "other", "third", "quote", "size"))

    def coded(length: int) -> Column:
        return F.substring("code", 1, length)

    digits = F.conv(hexed(13, 20), 16, 10)
    uuid = F.concat_ws("-", hexed(8), hexed(4, 9), hexed(4, 13), hexed(4, 17), hexed(12, 21))
    password = F.concat(word, one_of(["!", "$", "#", "%", "&"], "sign"), hexed(4), one_of(["", "?x", "*", "Q"], "end"))
    path = F.concat(F.lit("/usr/lib/"), word, F.lit("/"), other, F.lit("-2/"), word, F.lit("_"), third)
    slug = F.concat_ws("-", word, other, third, one_of(WORDS, "fourth"))
    kinds = [
        # (is a secret, what stands before it, the value, what stands after it)
        (True, F.concat(name, F.lit(" = "), quote), size, quote),
        (True, F.concat(name, F.lit(": ")), coded(40), F.lit("")),
        (True, F.lit("Authorization: Bearer "), coded(60), F.lit("")),
        (True, F.concat(word, F.lit(" ")), F.concat(F.lit("AKIA"), F.upper(hexed(16))), F.concat(F.lit(" "), other)),
        (True, F.concat(name, F.lit("="), quote), password, quote),
        (True, F.concat(F.lit("see https://"), word, F.lit(":")), F.concat(hexed(6), other), F.lit("@host.example/")),
        (True, F.concat(F.lit("the "), one_of(NAMES[:9], "prose"), F.lit(" ")), size, F.concat(F.lit(" "), other)),
        (True, F.concat(F.upper(name), F.lit(" = \"")), F.upper(size), F.lit("\"")),
        (False, F.concat(one_of(["commit ", "merge of ", "revision ", "parent "], "git")), hexed(40), F.concat(F.lit(" "), other)),
        (False, F.concat(one_of(["sha256: ", "checksum = ", "digest: "], "sum")), hexed(64), F.lit("")),
        (False, F.concat(one_of(["md5=", "md5sum ", "hash: "], "md5")), hexed(32), F.lit("")),
        (False, one_of(["id: ", "uuid=", "request ", "guid "], "uuid"), uuid, F.lit("")),
        (False, F.lit("src=\"data:image/png;base64,"), F.concat(coded(85), coded(70)), F.lit("\"")),
        (False, F.concat(word, F.lit(" ")), path, F.lit("")),
        (False, F.concat(word, F.lit(" ")), F.lpad(digits, 16, "4"), F.concat(F.lit(" "), other)),
        (False, F.concat(word, F.lit(" ")), F.concat(word, other, word, other), F.lit(". ")),
        (False, F.concat(name, F.lit(": ")), F.concat(word, F.lit("s"), other), F.lit(" ")),
        (False, F.lit("https://www.example.com/?page:"), slug, F.lit(" ")),
        (False, F.lit("etag=\""), hexed(32), F.lit("\"")),
        (False, F.concat(word, F.lit(" = ")), F.concat(F.initcap(word), F.initcap(other), F.lit("FactoryBean")), F.lit("()")),
    ]
    # a frame for each kind keeps the generated code small
    each = [
        base.where(F.col("kind") % len(kinds) == i).select(
            "doc_id", F.concat(other, F.lit(" "), word, F.lit(" "), before, value, after, F.lit(" "), other).alias("text"), value.alias("value"), F.lit(yes).alias("is_secret")
        )
        for i, (yes, before, value, after) in enumerate(kinds)
    ]
    return kept_table(reduce(DataFrame.unionByName, each), "lines")


def labelled(spark: SparkSession, n: int = LINES, seed: int = 1) -> DataFrame:
    """Findings in the lines: those that are a line's value have its label, others none."""
    made = lines(spark, n, seed)
    found = secret_scan.findings(made).join(made.select("doc_id", "value", F.col("is_secret").alias("_label")), "doc_id")
    return found.withColumn("is_secret", F.when(F.col("candidate") == F.col("value"), F.col("_label"))).drop("value", "_label")
