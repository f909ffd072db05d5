"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from eventide.llm import (
    alignment,
    decontamination,
    language,
    line_dedup,
    near_dedup,
    packing,
    periodic,
    personal_data,
    quality,
    secret_scan,
    suffix_dedup,
    toxicity,
    vector_search,
)
from eventide.llm.common import saved, table
from eventide.session import shared_dir


def op4_decontamination(spark, sf_dir):
    """Words of documents inside benchmark windows, by document."""
    found = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op1_suffix_dedup(spark, sf_dir):
    """Bytes of every document that repeat an earlier string of 100 bytes, and a digest of the others."""
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_top_k(spark, sf_dir):
    """The 20 vectors of greatest inner product with each query."""
    vectors = table(spark, sf_dir, "embeddings")
    ints = vectors.select("vec_id", vector_search.quantised(F.col("embedding")).alias("vector"))
    return vector_search.top_k(ints, F.col("id") % 20 == 0)


def _held_out(fold, of):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == fold


def op3_toxicity(spark, sf_dir):
    """Toxicity score of every document; rows of the held-out third are not learned from."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_held_out(1, 3), F.lit(False))
    model = toxicity.train(docs.where(~held), table(spark, sf_dir, "labels").where(~held))
    found = toxicity.score(docs, model, ["doc_id", "lang"])
    return found.select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        (F.col("score") >= toxicity.limit_of(model)).alias("over_language_threshold"),
    )


def op5_language(spark, sf_dir):
    """Language of every document; rows of the held-out quarter are not learned from."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_held_out(2, 4), F.lit(False))
    model = language.train(docs.where(~held))
    found = language.identify(docs, model, ["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _count(kind):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op6_secrets(spark, sf_dir):
    """Secrets in every document, through a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents")
    ledger = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/ledger"
    secret_scan.scan_new(docs, ledger)
    found = secret_scan.findings(docs, ledger)
    kinds = [rule.kind for rule in secret_scan.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op7_near_dedup(spark, sf_dir):
    """Near-duplicate component of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir):
    """Lines taken from every document, and a digest of what is left."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_equal=1)
    return out.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda k: k.cast("string")), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op9_packing(spark, sf_dir):
    """Every document's pieces in bins of several lengths."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_personal_data(spark, sf_dir):
    """Personal data in every document."""
    proposed = personal_data.propose(table(spark, sf_dir, "documents"))
    found = personal_data.select_spans(proposed, personal_data.train(proposed))
    ranks = F.create_map(*[F.lit(x) for i, kind in enumerate(personal_data.KINDS) for x in (kind, i)])
    ordered = F.array_sort(
        F.transform(
            "spans", lambda s: F.struct(s["start"], F.element_at(ranks, s["kind"]).alias("rank"), s["stop"], s["kind"])
        )
    )
    base = F.filter("spans", lambda s: s["kind"].isin(list(personal_data.STRICT)))
    return found.select("doc_id", ordered.alias("spans")).select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in personal_data.STRICT],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op11_quality(spark, sf_dir):
    """Quality of every document; rows of the held-out quarter are not learned from."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_held_out(2, 4), F.lit(False))
    model = quality.train(docs.where(~held), table(spark, sf_dir, "labels").where(~held))
    scored = saved(quality.score(docs, model, ["doc_id"]), "quality")
    return quality.above_quantile(scored, model.quantile, "above_quantile").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "above_quantile"
    )


def _made_periodic(docs):
    """Documents of which every tenth repeats its words from somewhere on, as the contract of op12 says."""
    words = F.coalesce(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), F.array().cast("array<string>"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    chosen = docs.select("doc_id", "text", h.alias("h"), g.alias("g"))
    is_chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    chosen = chosen.withColumn("w", F.when(is_chosen, words)).withColumn("n", F.size("w").cast("long"))
    a = F.when(F.col("n") > 0, F.col("g") % F.col("n"))
    chosen = chosen.withColumn("a", a)
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("long")
    chosen = chosen.withColumn("p", p)
    again = F.transform(
        F.sequence("a", F.col("n") - 1), lambda i: F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
    )
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), again), " ")
    return chosen.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    """Runs of repeating words in every document, and a digest of the text without the repeats."""
    docs = _made_periodic(table(spark, sf_dir, "documents"))
    found = periodic.periodic_runs(docs, ["doc_id"])
    # The greatest length first, then the smallest start and period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    length, period = F.col("best")["length"], -F.col("best")["col3"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best")["col2"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_alignment(spark, sf_dir):
    """Tokens of two tokenizers that overlap, in every document, and how common their pairs are."""
    found = alignment.align(table(spark, sf_dir, "documents"), ["doc_id"], groups=alignment.SHA256)
    return found.withColumnRenamed("groups", "groups_sha256")


def queries():
    return {
        "op6_secrets": op6_secrets,
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_top_k": op2_top_k,
        "op7_near_dedup": op7_near_dedup,
        "op8_line_dedup": op8_line_dedup,
        "op9_packing": op9_packing,
        "op10_personal_data": op10_personal_data,
        "op3_toxicity": op3_toxicity,
        "op5_language": op5_language,
        "op4_decontamination": op4_decontamination,
        "op11_quality": op11_quality,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_alignment": op13_alignment,
    }


def oracle_sql():
    return {
        "op2_top_k": OP2_SQL,
        "op4_decontamination": OP4_SQL,
        "op7_near_dedup": OP7_SQL,
        "op8_line_dedup": OP8_SQL,
    }


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS win
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(win) AS n FROM win),
doc AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
place AS (
    SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, size WHERE len(w) >= n),
hit AS (
    SELECT r, i, n, item_id FROM (SELECT r, i, n, list_slice(w, i, i + n - 1) AS win FROM place) p JOIN win USING (win)),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS k FROM hit) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

# Two texts are one edit apart if what they share at the front and at the back leaves at
# most one character of the longer; every length of the front is tried.
OP8_SQL = r"""
WITH line AS (
    SELECT doc_id, nr, lower(trim(line, E' \t\r')) AS line
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS nr
          FROM documents)
    WHERE length(trim(line, E' \t\r')) >= 1),
first AS (
    SELECT line, length(line) AS n, min({'d': doc_id, 'nr': nr}) AS pos FROM line GROUP BY line),
pair AS (
    SELECT a.line, a.pos, b.line AS other, a.n AS n, b.n AS m FROM first a JOIN first b
    ON a.n >= 20 AND b.n >= 20 AND b.n IN (a.n - 1, a.n, a.n + 1) AND b.pos < a.pos
    AND (left(a.line, least(a.n, b.n) // 2) = left(b.line, least(a.n, b.n) // 2)
         OR right(a.line, least(a.n, b.n) - least(a.n, b.n) // 2) = right(b.line, least(a.n, b.n) - least(a.n, b.n) // 2))),
near AS (
    SELECT DISTINCT line FROM pair
    WHERE len(list_filter(generate_series(0, greatest(n, m) - 1), lambda k:
        left(line, k) = left(other, k) AND right(line, greatest(n, m) - k - 1) = right(other, greatest(n, m) - k - 1))) > 0),
gone AS (
    SELECT doc_id, nr FROM line JOIN first USING (line)
    WHERE {'d': doc_id, 'nr': nr} > pos OR line IN (FROM near)),
listed AS (SELECT doc_id, list_sort(list(nr)) AS removed FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(removed), 0) AS n_removed,
       coalesce(array_to_string(removed, ','), '') AS removed,
       sha256(CASE WHEN removed IS NULL THEN coalesce(text, '')
              ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(removed, i - 1)), chr(10)) END)
           AS kept_sha256
FROM documents LEFT JOIN listed USING (doc_id)
"""

OP7_SQL = r"""
WITH RECURSIVE token AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, hash(list_slice(w, i, i + 3)) AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM token WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
    SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
either AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS node, doc_id AS low FROM documents
          UNION SELECT b, low FROM reach JOIN either ON node = a),
named AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM documents LEFT JOIN size USING (doc_id) JOIN named ON node = doc_id
"""

OP2_SQL = """
WITH vec AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM vec q JOIN vec d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id AND len(q.v) = len(d.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair)
WHERE rank <= 20
"""
