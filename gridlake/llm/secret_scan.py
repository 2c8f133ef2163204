"""Secret scan with a random forest against false positives (operator 2).

Candidates are long runs of the characters that keys and tokens are made of;
signed web tokens and private keys in armour, each as a whole; the password of a
URL (``://user:password@``); and, of any length and characters, the value after a
name of a secret, up to its closing quote or else to white space. A random forest, trained on labelled findings, judges each by

* its length and the shares of digits, capitals and other signs,
* its character transitions: changes of character class, and the mean log
  probability of its letter pairs in the corpus's own words,
* dictionary coverage: the share that frequent words of the corpus cover,
* its path: whether it is part of a URL or file path, or assigned to a name,
* the neighbouring words, those that tell most about the label.

Everything runs as DataFrame expressions and Spark's own forest; no Python on
the executors. The two word tables count all words of all texts. The forest is
fitted on a sample of bounded size (``MAX_FINDINGS``); every candidate of every
whole text is scored.

Null and empty texts have no candidates. Rows that repeat an id are scanned
each by itself. If the findings hold one label only, or there are none, the
labels themselves decide and no forest is grown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage, texts, unit_hash

#: What a candidate is made of, and formats that are secrets for certain.
CANDIDATE = "[A-Za-z0-9+/_-]{16,}={0,2}"
KEY_FORMATS = (
    r"(?<![A-Za-z0-9+/_-])(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{16,}|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{16,})(?![A-Za-z0-9+/_-])"
    r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:\\[nr]|\s)+[A-Za-z]"
)
#: A signed token (header, payload, signature), and an armoured private key; its body holds no dash but in its headers.
_JWT = r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
_ARMOUR = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----\s+(?:(?:Proc-Type|DEK-Info):[^\r\n]*\s+){0,2}[^-]*+-----END [A-Z ]{0,20}PRIVATE KEY-----"
#: What stands before the password of a URL.
_USER = r"://[^\s/:@\"']*:"
_NAME = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth)\\?[\"']?\s*(?:=>|:=|={1,3}|:)\s*"
SECRET_NAMES = _NAME + r"(?:\\?[\"'])?$"
#: A name with what stands before its value; a run of the candidates' characters may end in the name.
_LEAD = rf"[A-Za-z0-9+/_-]*{_NAME}(?:\\?[\"'])?|{_USER}"
#: Up to the closing quote of the line; else a candidate before closing signs, or all up to white space.
_VALUE = "|".join([
    rf"(?:\\?[\"'])?{_ARMOUR}",
    *[rf"\\?{q}[^{q}\r\n]*[^{q}\r\n\\](?=\\?{q}|$)" for q in "\"'"],
    rf"(?:\\?[\"'])?(?:{CANDIDATE}(?=[,;.)\]}}>]*(?:\\?[\"']|\s|$))|[^\s\"']+)",
])
#: Each begins where a run of the candidates' characters does, or with the sign after a URL's scheme.
PATTERN = rf"(?<![A-Za-z0-9+/_-])(?:{_ARMOUR}|{_JWT}|[A-Za-z0-9+/_-]*{_NAME}(?:{_VALUE})|{CANDIDATE})|{_USER}[^\s/@\"']+(?=@)"
LETTERS = "abcdefghijklmnopqrstuvwxyz0"

MAX_FINDINGS = 20_000
DICTIONARY = 300
NEIGHBOURS = 16
MARK = "[SECRET]"


def _lead(match: Column) -> Column:
    """What of a match stands before its value: nothing unless it begins with a name; a value is never empty."""
    return F.regexp_extract(match, rf"^({_LEAD})(?=[\s\S])", 1)


def _value(match: Column, lead: Column) -> Column:
    return F.substring(match, F.length(lead) + 1, F.length(match))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start (characters before it), candidate, before, after: every candidate of every text."""
    parts = texts(docs).where(F.col("text").rlike(PATTERN)).select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found"),
        F.split("text", PATTERN, -1).alias("gaps"),
    )
    each = F.transform("found", lambda x, i: F.struct(x.alias("match"), _lead(x).alias("lead"), F.get("gaps", i).alias("gap"), F.get("gaps", i + 1).alias("next")))
    rows = parts.select("doc_id", "row", F.posexplode(each).alias("i", "x")).select(
        "doc_id", "row", "i", "x.match", _value(F.col("x.match"), F.col("x.lead")).alias("candidate"), F.length("x.gap").alias("gap"),
        F.right(F.concat("x.gap", "x.lead"), F.greatest(F.lit(48), F.length("x.lead"))).alias("before"), F.left("x.next", F.lit(32)).alias("after"),
    )
    upto = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    return rows.select("doc_id", (end - F.length("candidate")).cast("long").alias("start"), "candidate", "before", "after")


def labelled(found: DataFrame) -> DataFrame:
    """Labels where they are certain: 1 for known key formats, and for passwords of URLs and values of names
    of secrets that hold a digit, but short numbers; 0 for words, numbers and parts of paths; null, for the
    forest to judge, otherwise."""
    c = F.col("candidate")
    digit = c.rlike("[0-9]")
    password = F.col("before").rlike(f"{_USER}$") & F.col("after").startswith("@")
    return found.withColumn(
        "label",
        F.when(c.rlike(KEY_FORMATS), 1.0)
        .when(password, F.when(digit, 1.0))
        .when(F.col("before").rlike(SECRET_NAMES) & digit, F.when(c.rlike("[^0-9.,;:]") | c.rlike(CANDIDATE), 1.0))
        .when(~digit | c.rlike("^[0-9+/_=-]+$") | F.col("before").rlike(r"(://|www\.)\S*$"), 0.0),
    )


def _share(pattern: str) -> Column:
    """The share of the candidate's characters that match."""
    return 1 - F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")


class Features:
    """The numbers the forest sees, with the tables that some of them need."""

    def __init__(self, dictionary: list[str], transitions: list[float], neighbours: list[str]):
        self.dictionary, self.transitions, self.neighbours = dictionary, transitions, neighbours

    def add(self, found: DataFrame) -> DataFrame:
        low = F.regexp_replace(F.lower("candidate"), "[0-9]", "0")
        kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("candidate", "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0")
        runs = F.regexp_replace(kinds, r"(.)\1+", "$1")
        pair = lambda i: F.instr(F.lit(LETTERS), F.substring("low", i, 1)) * 28 + F.instr(F.lit(LETTERS), F.substring("low", i + 1, 1))
        steps = F.length("low") - 1
        fit = F.aggregate(F.sequence(F.lit(1), steps), F.lit(0.0), lambda s, i: s + F.get(F.col("table"), pair(i).cast("int"))) / steps
        fit = F.when(steps > 0, fit)  # a value of one character has no pairs
        words = "|".join(self.dictionary)
        before, after = F.lower("before"), F.lower("after")
        near = F.array(F.regexp_extract(before, r"([a-z]+)[^a-z]*$", 1), F.regexp_extract(after, r"^[^a-z]*([a-z]+)", 1))
        numbers = {
            "length": F.length("candidate").cast("double"),
            "digits": _share("[0-9]"),
            "capitals": _share("[A-Z]"),
            "signs": _share("[+/_=-]"),
            "hex": F.col("candidate").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
            "changes": F.length(runs) / F.length("candidate"),
            "transitions": F.col("fit"),
            "dictionary": (1 - F.length(F.regexp_replace("low", words, "")) / F.length("low")) if words else F.lit(0.0),
            "path": (before.rlike(r"(://|www\.|/)\S*$") | F.col("candidate").rlike("/[^/]+/")).cast("double"),
            "assigned": before.rlike(r"[=:]\s*[\"']?$").cast("double"),
        } | {f"near_{w}": F.array_contains(near, w).cast("double") for w in self.neighbours}
        table = F.array(*[F.lit(float(x)) for x in self.transitions])
        return (
            found.withColumn("low", low).withColumn("table", table).withColumn("fit", fit)
            .withColumn("x", F.array(*[F.coalesce(v, F.lit(0.0)) for v in numbers.values()])).drop("low", "table", "fit")
        )


def _tables(docs: DataFrame, findings: DataFrame, stage: Stage) -> Features:
    words = texts(docs).where("text is not null").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0))).alias("w"))
    tally = stage.write(words.groupBy("w").count(), "words")
    top = tally.orderBy(F.desc("count"), "w").limit(DICTIONARY).collect()  # the dictionary's size
    pairs = tally.select("count", F.explode(F.regexp_extract_all("w", F.lit("(?=([a-z]{2}))"), F.lit(1))).alias("p"))
    pairs = pairs.groupBy("p").agg(F.sum("count").alias("n")).collect()  # 26 x 26 at most
    count = {r["p"]: r["n"] for r in pairs}
    first = {a: sum(n for p, n in count.items() if p[0] == a) for a in LETTERS}
    import math

    rows = ["?", *LETTERS]
    transitions = [math.log2((count.get(a + b, 0) + 0.5) / (first.get(a, 0) + 14)) if a != "?" and b != "?" else -6.0 for a in rows for b in rows]
    near = findings.where("label is not null").select(
        "label", F.explode(F.array_distinct(F.array(
            F.regexp_extract(F.lower("before"), r"([a-z]+)[^a-z]*$", 1), F.regexp_extract(F.lower("after"), r"^[^a-z]*([a-z]+)", 1)
        ))).alias("w")
    ).where("w <> ''").groupBy("w").agg(F.sum("label").alias("one"), F.sum(1 - F.col("label")).alias("none"))
    worth = F.abs(F.log((F.col("one") + 1) / (F.col("none") + 1))) * F.sqrt(F.col("one") + F.col("none"))
    best = near.orderBy(worth.desc(), "w").limit(NEIGHBOURS).collect()  # the number of such features
    return Features(sorted((r["w"] for r in top), key=lambda w: (-len(w), w)), transitions, [r["w"] for r in best])


def scan(docs: DataFrame, findings: DataFrame | None = None, trees: int = 24, depth: int = 6, seed: int = 2) -> DataFrame:
    """Every candidate with its ``probability`` of being a secret: doc_id, start, candidate, probability.

    ``findings`` has the rows of ``candidates`` with a label of 0, 1 or null; unless given, ``labelled`` ones,
    and what matches ``KEY_FORMATS`` has probability 1.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    stage = Stage(docs.sparkSession, "secrets")
    found = stage.write(candidates(docs), "candidates")
    marked = labelled(found) if findings is None else findings
    features = _tables(docs, marked, stage)
    number = {r["label"]: r["count"] for r in marked.where("label is not null").groupBy("label").count().collect()}  # two rows
    if len(number) < 2:
        sure = labelled(found).withColumn("probability", F.coalesce("label", F.lit(0.0)))
        return sure.select("doc_id", "start", "candidate", "probability")
    half = MAX_FINDINGS / 2
    share = F.when(F.col("label") == 1, half / number[1.0]).otherwise(half / number[0.0])
    sample = marked.where("label is not null").where(unit_hash(F.struct("doc_id", "start", "candidate"), seed) < share)
    vectors = stage.write(features.add(sample).select("label", "x"), "sample").select("label", array_to_vector("x").alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(vectors)
    judged = forest.transform(features.add(found).withColumn("features", array_to_vector("x")))
    probability = F.get(vector_to_array("probability"), F.lit(1))
    if findings is None:  # a known format needs no judge
        probability = F.when(F.col("candidate").rlike(KEY_FORMATS), 1.0).otherwise(probability)
    return judged.select("doc_id", "start", "candidate", probability.alias("probability"))


def secrets(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The candidates that the forest confirms."""
    return scan(docs).where(F.col("probability") >= threshold)


def redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every confirmed secret of a document replaced by a mark wherever it is a candidate in it."""
    per_doc = secrets(docs, threshold).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("candidate").alias("_secrets"))
    joined = docs.join(per_doc, docs["doc_id"].cast("long").eqNullSafe(per_doc["_id"]), "left")
    found = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    mark = lambda x, lead: F.when(F.array_contains("_secrets", _value(x, lead)), F.concat(lead, F.lit(MARK))).otherwise(x)
    shown = F.transform(found, lambda x: mark(x, _lead(x)))
    gaps = F.split("text", PATTERN, -1)
    text = F.array_join(F.zip_with(gaps, shown, lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")
    return joined.withColumn("text", F.when(F.col("_secrets").isNotNull(), text).otherwise(F.col("text"))).drop("_id", "_secrets")
