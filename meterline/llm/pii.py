"""Operator 13: personal data by boosted trees over candidate spans.

Four kinds: email, ip, card, phone.  The base rules give spans by fixed
patterns and checks.  High-recall generators propose further spans that may
overlap each other: addresses with spelled or spaced signs, dotted numbers in
brackets, numbers with other separators or without a country code.  What no
base span touches is a candidate.  Boosted trees score it by its format
(digits, groups, separators, check digit, octets) and its context (neighbour
characters, cue words), and a threshold per kind selects what is added; of
overlapping ones the best stays.  Base spans always stay.

Nobody marked personal data, so the trees learn from the base spans: positive
rows are base spans of the corpus rewritten to a form the base rules do not
read (``rewritten``), in the context they were found in; negative rows are
candidates of the corpus that break a rule of their kind (check digit, octet
above 255, no top domain, too few digits) or that no cue word is near.  Valid
candidates next to a cue are neither.  All such rows of the corpus are used:
those of four fifths of the documents grow the trees, those of the last fifth
calibrate.  A kind's threshold is the lowest score from which on ``PRECISION``
of its rows there are positive, counted with every row above it; a kind
without enough rows there adds nothing.  (Which values Spark ML tries as
splits it picks itself; what a split gains is counted over all rows.)

Spans count code points, the end is exclusive.

DataFrame functions and Spark ML only: no Python runs on the executors.  A
text is marked up by one pass per pattern and cut at the marks, so only
matches with their surroundings leave the scan; running sums over a
document's matches place them.  A shuffle carries matches, not texts, and a
group is never more than what one text holds.  Patterns are possessive and
begin where a run begins, so long texts are read in linear time.

Defined results: null and empty texts have no spans.  Repeated rows are
documents of their own; null or repeated ids: see ``common.identified``.
Other columns are ignored.  An empty table gives an empty result; without
both labels to learn from, nothing is added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import identified, materialize, read

KINDS = ("email", "ip", "card", "phone")
#: Encloses matches while a text is cut; not in any pattern.
MARK, OTHER = "\u0001", "\u0002"
#: Code points of context on either side of a match.
BEFORE, AFTER = 40, 20
PRECISION, ENOUGH = 0.98, 10

#: The base patterns, beginning where a run of theirs begins.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+\-])|\G)[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
OPEN, CLOSE = r"[(\[{]", r"[)\]}]"
GENERATORS = {
    "email": rf"(?<![\p{{L}}0-9._%+\-])[\p{{L}}0-9._%+\-]++\x20?(?:@|{OPEN}\x20?(?i:at|@)\x20?{CLOSE})\x20?[\p{{L}}0-9\-]++"
             rf"(?:(?:\.|\x20\.\x20|\x20?{OPEN}\x20?(?i:dot|\.)\x20?{CLOSE}\x20?)[\p{{L}}0-9\-]++)*+",
    "ip": rf"(?<![0-9A-Za-z])[0-9]{{1,3}}+(?:\x20?{OPEN}?\x20?(?:\.|(?i:dot))\x20?{CLOSE}?\x20?[0-9]{{1,3}}+){{3}}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20\xA0._/\-]{0,3}+[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z.+\-])\+?+\(?+[0-9]++\)?+(?:[\x20\xA0./\-]{1,2}+\(?+[0-9]++\)?+){0,6}+",
}
#: What a text must hold for a pattern to be worth a pass over it.
NEEDS = {
    ("email", 0): "@", ("email", 1): rf"@|{OPEN}\x20?(?i:at)\x20?{CLOSE}", ("ip", 0): r"[0-9]\.[0-9]", ("ip", 1): "[0-9]",
    ("card", 0): "[0-9]", ("card", 1): "[0-9]", ("phone", 0): r"\+[0-9]", ("phone", 1): "[0-9]",
}
OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?<=0))"
CUES = {
    "email": "(?i)(e-?mail|contact|write|reach|correo|courriel|kontakt|adress)",
    "ip": r"(?i)(\bip\b|host|server|login|client|gateway|address)",
    "card": "(?i)(card|visa|master|credit|debit|kredit|karte|carte|tarjeta|payment)",
    "phone": r"(?i)(phone|\btel|call|mobil|\bfax|whatsapp|teléfono|appel|anruf)",
}


# ------------------------------------------------------------------ matches

def scanned(text: F.Column, pattern: str, needs: str) -> F.Column:
    """The text cut at its matches: every second part is a match."""
    marked = F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}")
    return F.when(text.rlike(needs), F.split(marked, MARK, -1))


def matches(docs: DataFrame) -> DataFrame:
    """(rid, kind, loose, start, end, match, before, after) of all patterns,
    base (loose 0) and generators (1), over ``docs`` (rid, text)."""
    clean = docs.select("rid", F.replace("text", F.lit(MARK), F.lit(OTHER)).alias("text"))
    names = [(k, loose, f"p{k}{loose}") for k in range(len(KINDS)) for loose in (0, 1)]
    cut = clean.select("rid", *[scanned(F.col("text"), (GENERATORS if loose else BASE)[KINDS[k]],
                                        NEEDS[KINDS[k], loose]).alias(name) for k, loose, name in names])

    def rows(k: int, loose: int, name: str) -> F.Column:
        part = lambda i: F.element_at(name, i)
        found = F.transform(F.sequence(F.lit(2), F.size(name), F.lit(2)), lambda i: F.struct(
            F.lit(k).alias("kind"), F.lit(loose).alias("loose"), i.alias("i"),
            F.length(part(i - 1)).cast("long").alias("gap"), part(i).alias("match"),
            F.right(part(i - 1), F.lit(BEFORE)).alias("before"), F.left(part(i + 1), F.lit(AFTER)).alias("after")))
        return F.when(F.size(name) > 1, found).otherwise(F.array().cast(
            "array<struct<kind:int,loose:int,i:int,gap:bigint,match:string,before:string,after:string>>"))

    hits = cut.select("rid", F.explode(F.concat(*[rows(*n) for n in names])).alias("x")).select("rid", "x.*")
    order = Window.partitionBy("rid", "kind", "loose").orderBy("i")
    size = F.length("match").cast("long")
    return (hits.repartition("rid").withColumn("end", F.sum(F.col("gap") + size).over(order))
            .select("rid", "kind", "loose", (F.col("end") - size).alias("start"), "end", "match", "before", "after"))


def luhn(digits: F.Column) -> F.Column:
    """Whether up to 19 digits pass the check."""
    back = F.reverse(digits)

    def value(i):
        v = F.ascii(F.substr(back, i, F.lit(1))) - 48
        v = F.when(i <= F.length(back), v).otherwise(0)
        return F.when(i % 2 == 0, 2 * v - F.when(v > 4, 9).otherwise(0)).otherwise(v)
    return F.aggregate(F.sequence(F.lit(1), F.lit(19)), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def valid_base() -> F.Column:
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    return (F.when(F.col("kind") == 0, True)
            .when(F.col("kind") == 1, F.col("match").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
            .when(F.col("kind") == 2, F.when(n.between(16, 19), luhn(digits)).otherwise(False))
            .otherwise(n.between(8, 15)))


def candidates(found: DataFrame) -> DataFrame:
    """Valid base spans (base true), and generated spans that no base span of
    any kind touches."""
    digits = F.length(F.regexp_replace("match", "[^0-9]", ""))
    kept = found.withColumn("base", F.col("loose") == 0).filter(
        F.when(F.col("base"), valid_base()).when(F.col("kind") == 3, digits.between(7, 15)).otherwise(True))
    names, so_far = ("start", "loose", "kind", "end"), (Window.unboundedPreceding, -1)
    onward, back = (Window.partitionBy("rid").orderBy(*[way(n) for n in names]) for way in (F.asc, F.desc))
    before = F.max(F.when(F.col("base"), F.col("end"))).over(onward.rowsBetween(*so_far))
    # backwards, since a frame that begins behind a row is summed anew for each
    after = F.min(F.when(F.col("base"), F.col("start"))).over(back.rowsBetween(*so_far))
    return (kept.withColumn("b", before).withColumn("a", after)
            .filter(F.col("base") | ((F.coalesce("b", F.lit(0)) <= F.col("start"))
                                     & (F.coalesce("a", F.col("end")) >= F.col("end")))).drop("a", "b", "loose"))


# ----------------------------------------------------------------- features

def features(rows: DataFrame) -> DataFrame:
    """``rows`` (kind, match, before, after) with ``f_*`` columns."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    letters = F.length(F.regexp_replace("match", r"[^\p{L}]", ""))
    dotted = F.regexp_replace("match", rf"\x20?{OPEN}?\x20?(?:\.|(?i:dot))\x20?{CLOSE}?\x20?", ".")
    made = {
        **{f"kind_{name}": F.col("kind") == k for k, name in enumerate(KINDS)},
        "length": F.length("match"), "digits": n, "letters": letters, "others": F.length("match") - n - letters,
        "groups": F.size(F.split("match", "[^0-9]+")),
        "luhn": F.when(n.between(12, 19), luhn(digits)).otherwise(False),
        "octets": dotted.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        "domain": dotted.rlike(r"\.\p{L}{2,24}$"), "at": F.col("match").rlike(r"@|(?i:\bat\b)"),
        "plus": F.col("match").startswith("+"), "zeros": F.col("match").startswith("00"),
        "parenthesis": F.col("match").rlike(OPEN), "dots": F.size(F.split("match", r"\.")),
        "spaces": F.size(F.split("match", " ")), "first": F.coalesce(F.ascii(F.left(digits, F.lit(1))), F.lit(0)),
        "date": F.col("match").rlike(r"^(?:[12][0-9]{3}[./\-][0-9]{1,2}[./\-][0-9]{1,2}|[0-9]{1,2}[./\-][0-9]{1,2}[./\-][12][0-9]{3})$"),
        "letter_before": F.col("before").rlike(r"\p{L}$"), "digit_before": F.col("before").rlike(r"[0-9][\x20.,/\-]?$"),
        "sign_before": F.col("before").rlike(r"[=:#/_$€]\x20?$"), "letter_after": F.col("after").rlike(r"^\p{L}"),
        "digit_after": F.col("after").rlike(r"^[\x20.,/\-]?[0-9]"), "unit_after": F.col("after").rlike(r"^\x20?[%€$°]"),
        **{f"cue_{name}": F.col("before").rlike(cue) for name, cue in CUES.items()},
    }
    return rows.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"f_{name}") for name, c in made.items()])


def plausible() -> F.Column:
    """Candidates that keep the rules of their kind, with a cue near."""
    rule = [F.col("f_domain") == 1, F.col("f_octets") == 1, (F.col("f_luhn") == 1) & (F.col("f_digits") >= 13),
            (F.col("f_digits") >= 8) & (F.col("f_date") == 0)]
    return reduce(lambda a, b: a | b, [
        (F.col("kind") == k) & rule[k] & (F.col(f"f_cue_{name}") == 1) for k, name in enumerate(KINDS)])


def rewritten() -> F.Column:
    """A base span in a form that the base rules do not read."""
    m = F.col("match")
    digits = F.regexp_replace(m, "[^0-9]", "")
    forms = [
        [F.replace(m, F.lit("@"), F.lit(" (at) ")), F.regexp_replace(F.replace(m, F.lit("@"), F.lit(" [at] ")), r"\.(?=[A-Za-z0-9\-]+$)", " [dot] "),
         F.replace(m, F.lit("@"), F.lit(" @ "))],
        [F.replace(m, F.lit("."), F.lit("[.]")), F.replace(m, F.lit("."), F.lit(" . ")), F.replace(m, F.lit("."), F.lit("(dot)"))],
        [F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1."), F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1/"),
         F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1 - ")],
        [F.regexp_replace(m, r"^\+[0-9]{1,3}\x20?", ""), F.regexp_replace(m, r"^\+", "00"),
         F.regexp_replace(F.regexp_replace(m, r"^\+[0-9][^0-9]*", ""), r"[^0-9]+", ".")],
    ]
    form = F.pmod(F.xxhash64("rid", "start"), F.lit(3))
    out = F.lit(None).cast("string")
    for k, own in enumerate(forms):
        for j, column in enumerate(own):
            out = F.when((F.col("kind") == k) & (form == j), column).otherwise(out)
    return out


# -------------------------------------------------------------------- model

class Model:
    """Trees and the threshold of each kind; without trees nothing is added."""

    def __init__(self, trees=None, assembler: VectorAssembler | None = None, least: dict[int, float] | None = None):
        self.trees, self.assembler, self.least = trees, assembler, least or {}

    def scored(self, rows: DataFrame) -> DataFrame:
        if self.trees is None:
            return rows.withColumn("score", F.lit(0.0))
        return (self.trees.transform(self.assembler.transform(rows))
                .withColumn("score", vector_to_array("probability")[1])
                .drop("features", "rawPrediction", "probability", "prediction"))

    def accepts(self) -> F.Column:
        return reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("score") >= t) for k, t in self.least.items()],
                      F.lit(False))


def learn(hits: DataFrame, precision: float = PRECISION) -> Model:
    """Trees and thresholds from all ``candidates`` with a label."""
    columns = ("rid", "kind", "start", "match", "before", "after")
    good = features(hits.filter("base").withColumn("match", rewritten()).select(*columns)).withColumn("label", F.lit(1.0))
    bad = features(hits.filter("not base").select(*columns))
    bad = bad.filter(~plausible()).withColumn("label", F.lit(0.0))
    rows = materialize(good.unionByName(bad).withColumn(
        "held", F.pmod(F.xxhash64("rid", F.lit(7)), F.lit(5)) == 0), "labelled")
    fit, held = rows.filter("not held"), rows.filter("held")
    if fit.select("label").distinct().count() < 2:
        return Model()
    names = [c for c in rows.columns if c.startswith("f_")]
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(labelCol="label", maxIter=12, maxDepth=4, seed=5, cacheNodeIds=False).fit(
        assembler.transform(fit).select("features", "label"))
    model = Model(trees, assembler)
    own = model.scored(held).withColumn("score", F.floor(F.col("score") * 1000) / 1000)
    counted = own.groupBy("kind", "score").agg(F.sum("label").alias("good"), F.count("*").alias("n"))
    for k in range(len(KINDS)):                          # at most 1,001 scores a kind
        good_, n, least = 0.0, 0, None
        for row in counted.filter(F.col("kind") == k).orderBy(F.desc("score")).collect():
            good_, n = good_ + row["good"], n + row["n"]
            if good_ >= max(ENOUGH, precision * n):
                least = row["score"]
        if least is not None:
            model.least[k] = max(least, 0.5)
    return model


def personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per span of ``identified`` documents: (rid, kind, start, end,
    match, base, score)."""
    hits = materialize(candidates(matches(docs)), "candidates")
    model = model or learn(hits)
    base = hits.filter("base").select("rid", "kind", "start", "end", "match", "base", F.lit(1.0).alias("score"))
    if not model.least:
        return base
    more = model.scored(features(hits.filter("not base"))).filter(model.accepts())
    # of spans that overlap in a row, the best
    order = Window.partitionBy("rid").orderBy("start", "end", "kind")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    more = more.withColumn("new", F.when(F.col("start") < reached, 0).otherwise(1))
    more = more.withColumn("run", F.sum("new").over(order))
    best = Window.partitionBy("rid", "run").orderBy(F.desc("score"), F.desc(F.col("end") - F.col("start")), "kind", "start")
    more = more.withColumn("r", F.row_number().over(best)).filter("r = 1")
    return base.unionByName(more.select("rid", "kind", "start", "end", "match", "base", "score"))


def redacted(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(rid, text) of ``docs`` (rid, text) with each run of ``spans`` replaced
    by the name of its first kind in brackets."""
    order = Window.partitionBy("rid").orderBy("start", "end", "kind")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("new", F.when(F.col("start") < reached, 0).otherwise(1)).withColumn(
        "run", F.sum("new").over(order))
    runs = runs.groupBy("rid", "run").agg(F.min(F.struct("start", "kind")).alias("s"), F.max("end").alias("end"))
    ends = runs.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(
        F.col("s.start").alias("start"), "end", F.upper(F.element_at(F.array(*map(F.lit, KINDS)), F.col("s.kind") + 1)).alias("name")))).alias("s"))
    done = F.aggregate("s", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda acc, x: F.struct(
        F.concat(acc["out"], F.substr("text", (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")),
                 F.lit("["), x["name"], F.lit("]")).alias("out"), x["end"].alias("at")))
    return (docs.select("rid", "text").join(ends, "rid", "left").withColumn("done", F.when(F.col("s").isNotNull(), done))
            .select("rid", F.when(F.col("s").isNull(), F.col("text")).otherwise(F.concat(
                F.col("done.out"), F.substr("text", (F.col("done.at") + 1).cast("int")))).alias("text")))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = identified(read(spark, sf_dir, "documents"))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    count = [F.sum(F.when(F.col("base") & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{kind}")
             for k, kind in enumerate(KINDS)]
    lists = personal_data(docs).groupBy("rid").agg(*count, F.sort_array(F.collect_list(F.struct(
        "kind", "start", "end", "base", F.concat_ws(":", name, "start", "end").alias("span")))).alias("s"))
    joined = lambda s: F.array_join(F.transform(s, lambda x: x["span"]), ",")
    return (docs.select("rid", "doc_id").join(lists, "rid", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(joined(F.filter("s", lambda x: x["base"])), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined("s"), F.lit("")).alias("spans")))
