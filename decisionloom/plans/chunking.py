"""Queries from texts to chunks and the SQL that repeats them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from decisionloom.functions import html, ids, text, vocab
from decisionloom.operators import chunking as C
from decisionloom.plans.tables import table

#: SQL: paragraphs of documents.
PARAS = """paras AS (SELECT doc_id, text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS para FROM (
  SELECT doc_id, unnest(l) AS text, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM documents)))"""
LENGTHS = f"{PARAS}, ln AS (SELECT doc_id, list(length(text) ORDER BY para) AS l FROM paras GROUP BY doc_id)"


def paras(spark, d):
    return C.paragraphs(table(spark, d, "documents"), ["doc_id"])


def paragraph_split(spark, d):
    p = paras(spark, d)
    return p.select("doc_id", "para", F.length("text").cast("long").alias("chars"), F.md5("text").alias("hash"), ((F.length("text") <= 80) & ~F.col("text").rlike("[a-zß-öø-ÿœ]")).alias("heading"))


SPLIT = f"WITH {PARAS} SELECT doc_id, para, length(text) AS chars, md5(text) AS hash, length(text) <= 80 AND NOT regexp_matches(text, '[a-zß-öø-ÿœ]') AS heading FROM paras"


def lost_words_multiset(spark, d):
    """Words of each document that its paragraphs of at least 40 characters don't hold."""
    words = lambda df: df.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(vocab.TOKEN), F.lit(0))).alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    raw, kept = words(table(spark, d, "documents").select("doc_id", "text")), words(paras(spark, d).filter(F.length("text") >= 40)).withColumnRenamed("n", "have")
    lost = raw.join(kept, ["doc_id", "word"], "left").withColumn("lost", F.col("n") - F.coalesce("have", F.lit(0))).filter("lost > 0")
    return lost.groupBy("doc_id").agg(F.sum("lost").alias("lost"), F.countDistinct("word").alias("words"))


_WORDS = "SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{t}')) AS word FROM {f}) GROUP BY ALL"
LOST = f"""WITH {PARAS}, r AS ({_WORDS.format(t=vocab.TOKEN, f="documents")}), k AS ({_WORDS.format(t=vocab.TOKEN, f="(SELECT * FROM paras WHERE length(text) >= 40)")})
SELECT doc_id, CAST(sum(r.n - coalesce(k.n, 0)) AS BIGINT) AS lost, count(*) AS words FROM r LEFT JOIN k USING (doc_id, word) WHERE r.n > coalesce(k.n, 0) GROUP BY doc_id"""


def _folded(spark, d, groups, docs=None):
    """doc_id, group, first and last paragraph, characters."""
    p = paras(spark, d).withColumn("chars", F.length("text"))
    arrays = C.ordered(p, ["doc_id"], "para", "chars").withColumn("g", groups(F.col("values")))
    rows = arrays.select("doc_id", F.posexplode(F.arrays_zip("values", "g")).alias("i", "x")).select("doc_id", (F.col("i") + 1).alias("para"), F.col("x.g").alias("grp"), F.col("x.values").alias("chars"))
    return rows.groupBy("doc_id", "grp").agg(F.min("para").alias("lo"), F.max("para").alias("hi"), F.sum("chars").alias("chars"))


def greedy_pack_fallback(spark, d):
    return _folded(spark, d, lambda v: C.pack_groups(v, vocab.SIZE_CAP))


def request_windows(spark, d):
    return _folded(spark, d, lambda v: C.window_groups(v, 5, 3000))


def merge_to_target(spark, d):
    return _folded(spark, d, lambda v: C.merge_groups(v, 1000))


def _recursive(state: str, first: str, step: str, source: str = LENGTHS, group: str = "g") -> str:
    """A fold over ln(doc_id, l); state columns, their values at the first element (x) and at the next ones."""
    return f"""WITH RECURSIVE {source},
f AS (SELECT doc_id, l, 1 AS i, l[1] AS x, {first} FROM (SELECT *, l[1] AS x FROM ln) WHERE len(l) > 0
  UNION ALL SELECT doc_id, l, i, x, {step} FROM (SELECT doc_id, l, i + 1 AS i, l[i + 1] AS x, {state} FROM f WHERE i < len(l)))
SELECT doc_id, CAST({group} AS INTEGER) AS grp, CAST(min(i) AS INTEGER) AS lo, CAST(max(i) AS INTEGER) AS hi, CAST(sum(x) AS BIGINT) AS chars FROM f GROUP BY doc_id, {group}"""


PACK = _recursive("g, used", "1 AS g, x AS used", "CASE WHEN used + 1 + x > 2000 THEN g + 1 ELSE g END AS g, CASE WHEN used + 1 + x > 2000 THEN x ELSE used + 1 + x END AS used")
WINDOWS = _recursive("g, n, used", "1 AS g, 1 AS n, x AS used", "CASE WHEN n >= 5 OR used + x > 3000 THEN g + 1 ELSE g END AS g, CASE WHEN n >= 5 OR used + x > 3000 THEN 1 ELSE n + 1 END AS n, CASE WHEN n >= 5 OR used + x > 3000 THEN x ELSE used + x END AS used")
MERGE = _recursive("nx, nu", "1 AS g, CASE WHEN x >= 1000 THEN 2 ELSE 1 END AS nx, CASE WHEN x >= 1000 THEN 0 ELSE x END AS nu", "nx AS g, CASE WHEN nu + x >= 1000 THEN nx + 1 ELSE nx END AS nx, CASE WHEN nu + x >= 1000 THEN 0 ELSE nu + x END AS nu")


def memory_bounded_batches(spark, d):
    """Batches of a document's paragraphs by estimated tokens, shortest first."""
    p = paras(spark, d).withColumn("tokens", F.greatest(F.lit(1), F.floor(F.length("text") / 4)).cast("int"))
    arrays = p.groupBy("doc_id").agg(F.array_sort(F.collect_list("tokens")).alias("values"))
    rows = arrays.withColumn("g", C.batch_groups(F.col("values"), 100_000, 8)).select("doc_id", F.explode(F.arrays_zip("values", "g")).alias("x"))
    return rows.groupBy("doc_id", F.col("x.g").alias("grp")).agg(F.count("*").alias("texts"), F.max("x.values").alias("longest"))


BATCHES = _recursive("g, n", "1 AS g, 1 AS n", "CASE WHEN n >= 8 OR (n + 1) * x * x > 100000 THEN g + 1 ELSE g END AS g, CASE WHEN n >= 8 OR (n + 1) * x * x > 100000 THEN 1 ELSE n + 1 END AS n", f"{PARAS}, ln AS (SELECT doc_id, list(greatest(1, length(text) // 4) ORDER BY greatest(1, length(text) // 4)) AS l FROM paras GROUP BY doc_id)")
BATCHES = BATCHES[: BATCHES.rindex("SELECT doc_id, CAST(g")] + "SELECT doc_id, CAST(g AS INTEGER) AS grp, count(*) AS texts, CAST(max(x) AS INTEGER) AS longest FROM f GROUP BY doc_id, g"


def fill_uncovered_gaps(spark, d):
    """Runs left over when every third paragraph, and the one after, is taken away; written as ranges."""
    p = paras(spark, d).withColumn("n", F.max("para").over(Window.partitionBy("doc_id")))
    covered = p.withColumn("para", F.when((F.col("para") % 3 != 0) & (F.col("para") % 3 != 1), F.col("para")))
    return C.range_text(C.gaps(covered, ["doc_id"]), ["doc_id"])


GAPS = f"""WITH {PARAS}, u AS (SELECT doc_id, para, para - row_number() OVER (PARTITION BY doc_id ORDER BY para) AS i FROM paras WHERE para % 3 IN (0, 1)),
r AS (SELECT doc_id, min(para) AS lo, max(para) AS hi FROM u GROUP BY doc_id, i)
SELECT doc_id, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo::VARCHAR || '-' || hi::VARCHAR END, ', ' ORDER BY lo) AS ranges FROM r GROUP BY doc_id"""


def first_owner_dedupe(spark, d):
    """Two segmentations that overlap: by fours, and by threes from the second; who owns what, and who is left with nothing."""
    p = paras(spark, d)
    one = p.select("doc_id", F.floor((F.col("para") - 1) / 4).cast("long").alias("seg"), "para")
    two = p.filter("para > 1").select("doc_id", (1000 + F.floor((F.col("para") - 2) / 3)).cast("long").alias("seg"), "para")
    owned = C.first_owner(one.unionByName(two.filter("para % 5 <> 0")), ["doc_id"])
    counts = owned.groupBy("doc_id").agg(F.count("*").alias("listed"), F.count_if(F.col("seg") == F.col("owner")).alias("owned"))
    return counts.join(C.aliases(owned, ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("emptied"), F.sum("alias").alias("aliases")), "doc_id", "left")


OWNER = f"""WITH {PARAS}, s AS (SELECT doc_id, CAST(floor((para - 1) / 4) AS BIGINT) AS seg, para FROM paras UNION ALL SELECT doc_id, CAST(1000 + floor((para - 2) / 3) AS BIGINT), para FROM paras WHERE para > 1 AND para % 5 <> 0),
o AS (SELECT *, min(seg) OVER (PARTITION BY doc_id, para) AS owner FROM s),
a AS (SELECT doc_id, seg, min_by(owner, para) AS alias FROM o GROUP BY ALL HAVING count(*) FILTER (owner = seg) = 0)
SELECT doc_id, listed, owned, emptied, aliases FROM (SELECT doc_id, count(*) AS listed, count(*) FILTER (seg = owner) AS owned FROM o GROUP BY doc_id) LEFT JOIN (SELECT doc_id, count(*) AS emptied, CAST(sum(alias) AS BIGINT) AS aliases FROM a GROUP BY doc_id) USING (doc_id)"""


def same_role_runs(spark, d):
    runs = C.runs(table(spark, d, "conversations"), ["conv_id"], "turn", "role")
    parts = runs.select("conv_id", "run", F.concat_ws("×", "role", F.col("n").cast("string")).alias("s"))
    return parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("run", "s"))).alias("r"), F.count("*").alias("runs")).select("conv_id", "runs", F.array_join(F.transform("r", lambda x: x["s"]), ",").alias("roles"))


RUNS = """WITH b AS (SELECT *, CASE WHEN lag(role) OVER w = role AND lag(turn) OVER w = turn - 1 THEN 0 ELSE 1 END AS b FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT *, sum(b) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM b), g AS (SELECT conv_id, run, role, count(*) AS n FROM r GROUP BY ALL)
SELECT conv_id, count(*) AS runs, string_agg(role || '×' || n::VARCHAR, ',' ORDER BY run) AS roles FROM g GROUP BY conv_id"""


def piece_offsets_assignment(spark, d):
    """Where the middle character of each document stands: its paragraph, by the offsets of the joined text."""
    p = C.offsets(paras(spark, d), ["doc_id"], "para", F.length("text"))
    middle = p.groupBy("doc_id").agg(F.expr("max(end) div 2").alias("at"))
    return p.join(middle, "doc_id").filter((F.col("start") <= F.col("at")) & (F.col("at") <= F.col("end"))).select("doc_id", "at", "para", "start", "end")


OFFSETS = f"""WITH {PARAS}, o AS (SELECT doc_id, para, length(text) AS n, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY para ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM paras),
m AS (SELECT doc_id, max(start + n) // 2 AS "at" FROM o GROUP BY doc_id)
SELECT doc_id, "at", para, start, start + n AS "end" FROM o JOIN m USING (doc_id) WHERE start <= "at" AND "at" <= start + n"""


def internal_gaps_order(spark, d):
    """Segments by a hash of the paragraph: missing numbers inside their range, characters dropped, and whether documents stay in order."""
    p = paras(spark, d).withColumn("seg", (F.col("para") * 7 % 4).cast("long"))
    per = p.groupBy("doc_id", "seg").agg(F.sort_array(F.collect_set("para")).alias("refs"))
    inside = per.select("doc_id", "seg", "refs", F.array_except(F.sequence(F.array_min("refs"), F.array_max("refs")), F.col("refs")).alias("missing"))
    w = Window.partitionBy("doc_id").orderBy("seg")
    out = inside.withColumn("late", F.coalesce(F.lag(F.array_min("refs")).over(w) > F.array_min("refs"), F.lit(False)))
    return out.groupBy("doc_id").agg(F.sum(F.size("missing")).alias("missing"), F.count_if("late").alias("late"), F.count("*").alias("segments"))


INTERNAL = f"""WITH {PARAS}, s AS (SELECT doc_id, para * 7 % 4 AS seg, min(para) AS lo, max(para) AS hi, count(*) AS n FROM paras GROUP BY ALL),
l AS (SELECT *, coalesce(lag(lo) OVER (PARTITION BY doc_id ORDER BY seg) > lo, false) AS late FROM s)
SELECT doc_id, CAST(sum(hi - lo + 1 - n) AS BIGINT) AS missing, count(*) FILTER (late) AS late, count(*) AS segments FROM l GROUP BY doc_id"""


def coverage_multiplicity(spark, d):
    """How many of two overlapping segmentations hold each paragraph."""
    p = paras(spark, d)
    rows = p.select("doc_id", "para", F.explode(F.array_distinct(F.array(F.concat(F.lit("a"), F.expr("para div 4").cast("string")), F.when(F.col("para") % 3 > 0, F.concat(F.lit("b"), F.expr("para div 6").cast("string")))))).alias("seg")).filter("seg is not null")
    times = rows.groupBy("doc_id", "para").agg(F.countDistinct("seg").alias("times"))
    return times.groupBy("times").agg(F.count("*").alias("paragraphs"))


COVERAGE = f"WITH {PARAS} SELECT CAST(CASE WHEN para % 3 > 0 THEN 2 ELSE 1 END AS BIGINT) AS times, count(*) AS paragraphs FROM paras GROUP BY 1"


def size_cap_split(spark, d):
    """Pieces of at most 500 characters of every paragraph, and whether they give it back."""
    p = paras(spark, d)
    rows = p.withColumn("pieces", html.size_splitter(500)(F.col("text")))
    return rows.select("doc_id", "para", F.size("pieces").alias("pieces"), F.array_max(F.transform("pieces", F.length)).alias("longest"), (F.regexp_replace(F.array_join("pieces", ""), r"\s", "") == F.regexp_replace("text", r"\s", "")).alias("whole"))


def html_paragraphs(spark, d):
    pages = table(spark, d, "pages").withColumn("p", html.html_paragraphs(F.col("html")))
    return pages.select("page_id", F.posexplode("p").alias("para", "text")).select("page_id", (F.col("para") + 1).alias("para"), "text")


def page_extraction(spark, d):
    """Every page read in all ways at once: what was taken, the words it loses, what the older strategies find, and the share of characters that comes through.  Every third page has its lines too."""
    lines = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("html", "<[^>]*>", "\n"))
    rows = html.extracted(table(spark, d, "pages"), "page_id", lines, F.col("html"))
    lost = F.aggregate(F.map_values("x.lost"), F.lit(0), lambda n, v: n + v)
    return rows.select("page_id", F.size("x.paragraphs").alias("paragraphs"), "x.taken", lost.alias("lost"), F.size("x.rescued").alias("rescued"), "x.strategy", *[F.element_at("x.found", k).alias(k) for k in html.STRATEGIES], "x.coverage", "x.refused")


def chunk_ids(spark, d):
    """Mechanical chunks of each document: label, identifiers by name, index within the document."""
    g = greedy_pack_fallback(spark, d)
    label = F.concat_ws("-", F.col("doc_id").cast("string"), ids.paragraph_range(F.col("lo"), F.col("hi")))
    index = F.row_number().over(Window.partitionBy("doc_id").orderBy("lo")) - 1
    return g.select("doc_id", label.alias("label"), ids.uuid5(vocab.NAMESPACE_DNS, label).alias("chunk_id"), index.alias("chunk_index"), ids.doc_of_label(label).alias("doc_of_label"))


_SHA = f"sha1(unhex('{vocab.NAMESPACE_DNS.replace('-', '')}') || encode(label))"
CHUNK_IDS = f"""WITH RECURSIVE g AS ({PACK.replace("WITH RECURSIVE", "WITH RECURSIVE", 1)}),
n AS (SELECT doc_id, lo, doc_id::VARCHAR || '-p' || lo::VARCHAR || CASE WHEN lo = hi THEN '' ELSE '_to_p' || hi::VARCHAR END AS label FROM g), h AS (SELECT *, {_SHA} AS h FROM n)
SELECT doc_id, label, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32] AS chunk_id,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY lo) - 1 AS INTEGER) AS chunk_index, doc_id::VARCHAR AS doc_of_label FROM h"""

_SQL = {"paragraph_split": SPLIT, "lost_words_multiset": LOST, "greedy_pack_fallback": PACK, "request_windows": WINDOWS, "merge_to_target": MERGE, "memory_bounded_batches": BATCHES, "fill_uncovered_gaps": GAPS, "first_owner_dedupe": OWNER, "same_role_runs": RUNS, "piece_offsets_assignment": OFFSETS, "internal_gaps_order": INTERNAL, "coverage_multiplicity": COVERAGE, "uuid5_ids": CHUNK_IDS}
QUERIES = {f.__name__: f for f in (paragraph_split, lost_words_multiset, greedy_pack_fallback, request_windows, merge_to_target, memory_bounded_batches, fill_uncovered_gaps, first_owner_dedupe, same_role_runs, piece_offsets_assignment, internal_gaps_order, coverage_multiplicity, size_cap_split, html_paragraphs, page_extraction)} | {"uuid5_ids": chunk_ids}
ORACLE_SQL = _SQL
