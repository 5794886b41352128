r"""Operator 3: line deduplication by winnowing over line hashes, in DataFrame functions only.

Every line with a word is hashed.  In each window of ``run_lines`` consecutive such
lines of a document the smallest hash is its fingerprint, so two equal windows
have equal fingerprints.  Fingerprint positions are counted by hash; a window whose fingerprint
occurs once cannot repeat and goes no further.  The remaining windows are keyed by
128 bits of their lines; a window that occurs earlier, in order of (id, line),
is repeated, and consecutive repeated windows are one run: the fingerprint's match
extended both ways.  Runs are deleted, with the blank lines inside them.  A
line of at least ``line_words`` words is a window of its own, so a long passage on one
line is a run too.

The first occurrence of every window stays.  Null ids come last; of equal ids the
order of the stored rows decides, so a repeated row loses its lines.  Null and
empty texts have no lines and stay as they are; of a text whose lines are all deleted an empty text stays.
A frequent line is combined map-side before any shuffle and nothing is paired
within its group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.session import stage

WORD = r"[^\x20\x09-\x0D]"


def _with_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (uid, id, text) with all lines, the places of those with a word, and these lines."""
    return (docs.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
            .withColumn("places", F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(WORD), i)),
                                           lambda p: p.isNotNull()))
            .withColumn("worded", F.filter("lines", lambda x: x.rlike(WORD))))


def _windows(docs: DataFrame, run_lines: int, line_words: int) -> DataFrame:
    """Per document ``windows``: start, lines, place and hash of the smallest line hash, and key of each."""
    hashed = _with_lines(docs).withColumn("hashes", F.transform("worded", lambda x: F.xxhash64(x)))

    def window(start: str, lines: str) -> str:
        part = f"slice(worded, {start} + 1, {lines})"
        sampled = f"slice(hashes, {start} + 1, {lines})"
        least = f"array_min({sampled})"
        return (f"named_struct('s', {start}, 'n', {lines}, 'h', {least}, "
                f"'p', cast({start} + array_position({sampled}, {least}) - 1 as int), "
                f"'k1', xxhash64({part}), 'k2', xxhash64(7, {part}))")

    least_chars = 2 * line_words - 1  # so many words need so many characters at least
    runs = (f"if(size(worded) < {run_lines}, array(), "
            f"transform(sequence(0, size(worded) - {run_lines}), i -> {window('i', str(run_lines))}))")
    alone = ("transform(filter(transform(worded, (x, i) -> "
             f"if(length(x) >= {least_chars} and regexp_count(x, r'{WORD}+') >= {line_words}, i, null)), "
             f"i -> i is not null), i -> {window('i', '1')})")
    return hashed.select("uid", "id", F.expr(f"concat({runs}, {alone})").alias("windows"))


def _repeated(docs: DataFrame, run_lines: int, line_words: int) -> DataFrame:
    """``uid, covered``: the numbers, among lines with a word, of the lines in repeated windows."""
    windows = stage(_windows(docs, run_lines, line_words), "windows")
    prints = windows.select(F.explode(F.array_distinct(
        F.transform("windows", lambda w: F.struct(w["p"].alias("p"), w["h"].alias("h"))))).alias("f"))
    shared = stage(prints.groupBy("f.h").count().filter("count > 1").select("h"), "shared")
    near = (windows.select("uid", "id", F.explode("windows").alias("w")).select("uid", "id", "w.*")
            .join(shared, "h", "left_semi"))
    near = stage(near.select("uid", "id", "s", "n", "k1", "k2"), "near")
    key = ["k1", "k2", "n"]
    place = F.struct(F.col("id").isNull().alias("z"), "id", "uid", "s")
    firsts = (near.groupBy(*key).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
              .filter("times > 1").select(*key, F.col("first.uid").alias("u"), F.col("first.s").alias("at")))
    later = near.join(stage(firsts, "firsts"), key).filter("not (uid = u and s = at)")
    return (later.groupBy("uid").agg(F.collect_set(F.struct("s", "n")).alias("found"))
            .select("uid", F.array_sort(F.array_distinct(F.flatten(F.transform(
                "found", lambda w: F.sequence(w["s"], w["s"] + w["n"] - 1))))).alias("covered")))


def deduplicate_lines(docs: DataFrame, run_lines: int = 2, line_words: int = 50,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_lines, n_deleted, deleted_runs, text`` of every row of ``docs``.

    Lines are those with a word; ``deleted_runs`` lists first and last line number (from 0,
    of all lines) of each deleted run; ``text`` is what stays.
    """
    stored = stage(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                               F.col(text_col).alias("text")), "texts")
    covered = stage(_repeated(stored, run_lines, line_words), "covered")
    # sorted and merged at every size: a sixth of all texts may have repeated lines
    joined = _with_lines(stored.join(covered.hint("merge"), "uid", "left")).withColumn(
        "covered", F.coalesce("covered", F.array().cast("array<int>")))
    # first and last line of each run of covered lines
    starts = F.expr("filter(covered, (c, j) -> not (c - 1 <=> get(covered, j - 1)))")
    ends = F.expr("filter(covered, (c, j) -> not (c + 1 <=> get(covered, j + 1)))")
    runs = (joined.withColumn("starts", starts).withColumn("ends", ends)
            .withColumn("runs", F.expr("transform(starts, (s, j) -> named_struct("
                                       "'a', get(places, s), 'b', get(places, get(ends, j))))")))
    # what lies before each run, and after the last
    gaps = F.expr("transform(concat(runs, array(named_struct('a', size(lines), 'b', size(lines)))), (r, j) -> "
                  "slice(lines, coalesce(get(runs, j - 1).b + 1, 0) + 1, "
                  "r.a - coalesce(get(runs, j - 1).b + 1, 0)))")
    kept = F.when(F.size("runs") == 0, F.col("text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    return runs.select(
        F.col("id").alias(id_col), F.size("worded").cast("long").alias("n_lines"),
        F.size("covered").cast("long").alias("n_deleted"),
        F.expr("array_join(transform(runs, r -> concat(r.a, '-', r.b)), ',')").alias("deleted_runs"),
        kept.alias("text"))


def oracle_sql(run_lines: int = 2, line_words: int = 50) -> str:
    """The same rows in DuckDB, over whole windows instead of fingerprints."""
    key = " || chr(10) || ".join(["line", *(f"lead(line, {k}) OVER o" for k in range(1, run_lines))])
    return f"""
        WITH lines AS (
            SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS p
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
        worded AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS i
            FROM lines WHERE regexp_matches(line, '{WORD}')),
        windows AS (
            SELECT doc_id, i AS s, {run_lines} AS n, {key} AS k FROM worded
            WINDOW o AS (PARTITION BY doc_id ORDER BY i)
            UNION ALL
            SELECT doc_id, i, 1, line FROM worded WHERE len(regexp_extract_all(line, '{WORD}+')) >= {line_words}),
        later AS (
            SELECT doc_id, s, n FROM windows WHERE k IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY n, k ORDER BY doc_id, s) > 1),
        covered AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS i FROM later),
        runs AS (
            SELECT doc_id, min(p) AS a, max(p) AS b, count(*) AS n
            FROM (SELECT doc_id, p, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run
                  FROM worded JOIN covered USING (doc_id, i))
            GROUP BY doc_id, run),
        deleted AS (
            SELECT doc_id, sum(n) AS n, string_agg(a || '-' || b, ',' ORDER BY a) AS r FROM runs GROUP BY doc_id),
        kept AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS t FROM lines
            WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.doc_id = lines.doc_id AND p BETWEEN a AND b)
            GROUP BY doc_id),
        counted AS (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id)
        SELECT doc_id, coalesce(counted.n, 0) AS n_lines, CAST(coalesce(deleted.n, 0) AS BIGINT) AS n_deleted,
               coalesce(deleted.r, '') AS deleted_runs,
               CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(kept.t, '') END AS text
        FROM documents LEFT JOIN counted USING (doc_id) LEFT JOIN deleted USING (doc_id)
        LEFT JOIN kept USING (doc_id)"""
