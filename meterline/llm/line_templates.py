"""Operator 8: line dedup by a log-template tree of fixed depth.

A line's path in the tree is its number of tokens and its first ``DEPTH``
tokens (all it has, if fewer), tokens with a digit standing as ``<*>``.  The
lines of a leaf vote: at every place the token that half of the leaf's
different lines have is a constant, the others are variable.  Lines that
agree with 7 of 10 places belong to the leaf's template.  The rest of the
leaf is split by each line's most frequent token that is no constant, and
votes again, ``SPLITS`` times; a line that agrees nowhere is a template of
its own.  So a leaf holds as many templates as it needs.

A template is frequent if it is in at least ``MIN_DOCS`` documents.  Whether
it recurs is told by the company it keeps outside the run of frequent lines
it stands in, so notices of several lines are judged as one.  A document
vouches for the templates of a run if the run has at most ``RUN`` lines and
at most twice as many as the document has infrequent ones, and at most a
quarter of the document's lines are frequent ones outside the run: documents
that are mostly made of shared lines are copies of each other, whose lines
are left to the dedup of documents.  A template recurs if the nearest
infrequent lines before it, in the documents that vouch, are at least
``MIN_DOCS`` different ones, and so are those after it (at the start or end
of a document the other side counts).  Copies have the same neighbours and
count once, however many there are.  All lines of recurring templates are
dropped, in all documents.

Lines end at ``\\n``; runs of other white space count as one space, and lines
without a token are nothing to the tree.  Kept lines stay as they are.

Defined results: null and empty texts have nothing to drop (a null comes
back empty).  Identical rows are copies.  Null or repeated ids: see
``common.identified``.  An empty table gives an empty result.

DataFrame functions only: no Python runs on the executors.  Texts are cut
into lines once, into a written table.  Leaves and templates are grouped with
partial sums, texts are joined where a hot leaf can be split, and the largest
group that is sorted together is the lines of one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import identified, materialize, read

DEPTH, MIN_DOCS = 3, 8
#: How often the rest of a leaf is split; lines of the longest notice.
SPLITS, RUN = 2, 5


def masked(text: str = "text") -> F.Column:
    """One space for white space inside lines, ``<*>`` for tokens with digits."""
    spaced = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09\\x0B-\\x0D]+", " ")
    return F.regexp_replace(spaced, "(?<![^ \\n])[^ \\n0-9]*+[0-9][^ \\n]*+", "<*>")


def lines_of(docs: DataFrame) -> DataFrame:
    """(rid, pos, line, id, g): one row per line with a token; ``g`` is its
    leaf, ``id`` its digest."""
    plain = F.transform(F.split(masked(), "\n", -1), lambda x, i: F.struct(i.alias("pos"), F.trim(x).alias("line")))
    lined = docs.select("rid", F.explode(F.filter(plain, lambda x: x["line"] != "")).alias("x")).select("rid", "x.*")
    tokens = F.split("line", " ")
    return lined.select("rid", "pos", "line", F.unhex(F.md5("line")).alias("id"),
                        F.xxhash64(F.size(tokens), F.concat_ws(" ", F.slice(tokens, 1, DEPTH))).alias("g"))


def voted(lines: DataFrame, split: bool) -> tuple[DataFrame, DataFrame | None]:
    """(id, c, tid) of the lines (id, g, line, c) that agree with their
    group's template, and the others with the group they are split into."""
    spelled = lambda rows: rows.select("id", "g", F.posexplode(F.split("line", " ")).alias("place", "token"))
    votes = spelled(lines).groupBy("g", "place", "token").agg(F.count("*").alias("votes"))
    best = votes.groupBy("g", "place").agg(F.sum("votes").alias("all"), F.max(F.struct("votes", "token")).alias("best"))
    constants = best.select("g", "place", F.when(2 * F.col("best.votes") >= F.col("all"), F.col("best.token")).alias("constant"))
    templates = constants.groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "constant"))),
                                                       lambda x: x["constant"]).alias("template"))
    agreeing = F.size(F.filter(F.zip_with(F.split("line", " "), "template", lambda a, b: a == b), lambda x: x))
    name = F.concat_ws(" ", F.col("g").cast("string"), F.concat_ws(" ", F.transform(
        "template", lambda x: F.coalesce(x, F.lit("<*>")))))
    judged = materialize(lines.join(templates, "g").select(
        "id", "g", "line", "c", F.when(10 * agreeing >= 7 * F.size("template"), F.unhex(F.md5(name))).alias("tid")), "voted")
    rest = judged.filter("tid is null").drop("tid")
    if not split:
        return judged.select("id", "c", F.coalesce("tid", "id").alias("tid")), None
    # the token of a line that most lines of its group have at its place
    pairs = (spelled(rest).filter(F.col("place") >= DEPTH).join(votes, ["g", "place", "token"])
             .join(constants, ["g", "place"]).filter(F.col("constant").isNull() | (F.col("token") != F.col("constant"))))
    top = pairs.groupBy("id").agg(F.max(F.struct("votes", (-F.col("place")).alias("p"), "token")).alias("top"))
    split_ = rest.join(top, "id", "left").select(
        "id", "line", "c", F.when(F.col("top").isNull(), F.xxhash64("g", "id")).otherwise(
            F.xxhash64("g", "top.p", "top.token")).alias("g"))
    return judged.filter("tid is not null").select("id", "c", "tid"), split_


def templates(places: DataFrame, min_docs: int) -> DataFrame:
    """(id, tid): the lines that may recur and their templates.

    Only leaves, and later parts of leaves, with enough lines are looked at.
    """
    def large(lines: DataFrame) -> DataFrame:
        often = lines.groupBy("g").agg(F.sum("c").alias("all")).filter(F.col("all") >= min_docs).select("g")
        # a merge join at every size: a few leaves would be sent to all tasks, many
        # cannot, and lines that share a leaf may be split over tasks
        return lines.join(often.hint("merge"), "g")

    often = places.groupBy("g").agg(F.count("*").alias("all")).filter(F.col("all") >= min_docs).select("g")
    lines = materialize(places.select("g", "line", "id").join(often.hint("merge"), "g")
                        .groupBy("g", "id", "line").agg(F.count("*").alias("c")), "lines")
    found = []
    for k in range(SPLITS + 1):
        done, rest = voted(lines, k < SPLITS)
        found.append(done)
        if rest is not None:
            lines = materialize(large(rest), "lines")
    joined = found[0]
    for done in found[1:]:
        joined = joined.unionByName(done)
    often = joined.groupBy("tid").agg(F.sum("c").alias("all")).filter(F.col("all") >= min_docs).select("tid")
    return joined.join(often, "tid").select("id", "tid")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(rid, pos) of every line of a recurring template of ``docs`` (rid, text)."""
    places = materialize(lines_of(docs), "places")
    met = materialize(places.select("id", "rid", "pos").join(templates(places, min_docs), "id")
                      .select("rid", "pos", "tid"), "met")
    frequent = (met.select("tid", "rid").distinct().groupBy("tid").agg(F.count("*").alias("n"))
                .filter(F.col("n") >= min_docs).select("tid"))
    marks = materialize(met.join(frequent, "tid"), "marks")

    # every line with the template it is frequent by, document by document
    lines = (places.select("rid", "pos", F.xxhash64("id").alias("h"), F.lit(None).cast("binary").alias("tid"))
             .unionByName(marks.withColumn("h", F.lit(None).cast("long")).select("rid", "pos", "h", "tid"))
             .repartition("rid").groupBy("rid", "pos").agg(F.max("h").alias("h"), F.max("tid").alias("tid")))
    onward, back = Window.partitionBy("rid").orderBy("pos"), Window.partitionBy("rid").orderBy(F.desc("pos"))
    whole, so_far = Window.partitionBy("rid"), (Window.unboundedPreceding, -1)
    own = F.when(F.col("tid").isNull(), F.col("h"))
    seen = (lines.withColumn("prev", F.last(own, True).over(onward.rowsBetween(*so_far)))
            .withColumn("run", F.count(own).over(onward))
            .withColumn("n", F.count("*").over(whole)).withColumn("f", F.count("tid").over(whole))
            .withColumn("r", F.count("tid").over(Window.partitionBy("rid", "run")))
            .withColumn("next", F.last(own, True).over(back.rowsBetween(*so_far))).filter("tid is not null"))
    vouched = materialize(
        seen.filter((F.col("r") <= RUN) & (2 * (F.col("n") - F.col("f")) >= F.col("r"))
                    & (4 * (F.col("f") - F.col("r")) <= F.col("n")))
        .select("tid", F.coalesce("prev", "next").alias("prev"), F.coalesce("next", "prev").alias("next")), "vouched")

    def different(column: str) -> DataFrame:
        return (vouched.select("tid", column).distinct().groupBy("tid").agg(F.count("*").alias("n"))
                .filter(F.col("n") >= min_docs).select("tid"))

    return marks.join(different("prev").join(different("next"), "tid"), "tid").select("rid", "pos")


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text, *extra): the text that
    is left, the number of its lines and of those dropped."""
    base = identified(docs, extra=extra)
    gone = recurring_lines(base, min_docs).groupBy("rid").agg(F.collect_set("pos").alias("gone"))
    lines = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("l", i)), "\n")
    return base.join(gone.hint("merge"), "rid", "left").withColumn("l", lines).select(
        "rid", "doc_id", *extra, F.size("l").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"))


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the text that is left."""
    return drop_recurring_lines(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _voted_sql(k: int) -> str:
    """The CTEs of one vote over ``u{k}`` (g, line, n): ``a{k}`` has the lines
    that agree, ``u{k + 1}`` the rest in the groups they are split into."""
    last = k == SPLITS
    return rf"""
t{k} AS (
  SELECT g, line, unnest(range(n)) AS place, unnest(string_split(line, ' ')) AS token FROM u{k}),
v{k} AS (
  SELECT g, place, token, count(*) AS votes FROM t{k} GROUP BY ALL),
b{k} AS (
  SELECT g, place, CASE WHEN 2 * max(votes) >= sum(votes) THEN max(CASE WHEN votes = top THEN token END) END AS constant
  FROM (SELECT *, max(votes) OVER (PARTITION BY g, place) AS top FROM v{k}) GROUP BY g, place),
s{k} AS (
  SELECT g, list(constant ORDER BY place) AS template FROM b{k} GROUP BY g),
j{k} AS (
  SELECT line, n, g, CASE WHEN 10 * len(list_filter(list_zip(string_split(line, ' '), template), lambda p: p[1] = p[2]))
                       >= 7 * n
              THEN g || chr(10) || array_to_string(list_transform(template, lambda t: coalesce(t, '<*>')), ' ')
              {"ELSE chr(10) || line" if last else ""} END AS template
  FROM u{k} JOIN s{k} USING (g)),
a{k} AS (
  SELECT line, template FROM j{k} WHERE template IS NOT NULL)""" + ("" if last else rf""",
x{k} AS (
  SELECT line, place, token, votes FROM (
    SELECT t.line, t.place, t.token, v.votes, row_number() OVER (PARTITION BY t.line ORDER BY v.votes DESC, t.place) AS r
    FROM j{k} JOIN t{k} t USING (g, line) JOIN v{k} v USING (g, place, token) JOIN b{k} b USING (g, place)
    WHERE j{k}.template IS NULL AND t.place >= {DEPTH} AND (b.constant IS NULL OR t.token <> b.constant)) WHERE r = 1),
u{k + 1} AS (
  SELECT line, n, g || chr(10) || CASE WHEN place IS NULL THEN chr(10) || line ELSE place || ' ' || token END AS g
  FROM j{k} LEFT JOIN x{k} USING (line) WHERE template IS NULL)""")


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, string_split(regexp_replace(
    regexp_replace(text, '[\x20\x09\x0B-\x0D]+', ' ', 'g'),
    '[^ \n]*[0-9][^ \n]*', '<*>', 'g'), chr(10)) AS a FROM d),
e AS (
  SELECT doc_id, unnest(range(len(a))) AS pos, trim(unnest(a), ' ') AS line FROM m),
f AS (
  SELECT doc_id, pos, line FROM e WHERE line <> ''),
u0 AS (
  SELECT DISTINCT line, len(string_split(line, ' ')) AS n,
         len(string_split(line, ' ')) || ' ' || array_to_string(string_split(line, ' ')[1:{DEPTH}], ' ') AS g FROM f),
{",".join(_voted_sql(k) for k in range(SPLITS + 1))},
k AS (
  {" UNION ALL ".join(f"SELECT line, template FROM a{k}" for k in range(SPLITS + 1))}),
o AS (
  SELECT template FROM f JOIN k USING (line) GROUP BY template HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
w AS (
  SELECT doc_id, pos, line, o.template FROM f JOIN k USING (line) LEFT JOIN o USING (template)),
p AS (
  SELECT *, CASE WHEN template IS NULL THEN line END AS own FROM w),
q AS (
  SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
         first_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next,
         count(own) OVER (PARTITION BY doc_id ORDER BY pos) AS run,
         count(*) OVER (PARTITION BY doc_id) AS n, count(template) OVER (PARTITION BY doc_id) AS f FROM p),
z AS (
  SELECT *, count(template) OVER (PARTITION BY doc_id, run) AS r FROM q),
r AS (
  SELECT template FROM z
  WHERE template IS NOT NULL AND r <= {RUN} AND 2 * (n - f) >= r AND 4 * (f - r) <= n
  GROUP BY template
  HAVING count(DISTINCT coalesce(prev, next)) >= {MIN_DOCS} AND count(DISTINCT coalesce(next, prev)) >= {MIN_DOCS}),
g AS (
  SELECT doc_id, list(DISTINCT pos) AS gone FROM w JOIN r USING (template) GROUP BY doc_id)
SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, coalesce(len(gone), 0) AS n_dropped,
       sha256(CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(
         string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)"""
