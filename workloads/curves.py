"""Curve texts, curve checks and curve matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.functions import conditions, curves
from measlake.functions.text import any_time
from measlake.operators import curve_match
from measlake.sources import reduced_text

from .base import composed, load, query, text

# --- matching -----------------------------------------------------------------

_MATCH_SQL = """
WITH points AS (
  SELECT vec_id, label, i AS pos, 2 + CAST(embedding[i] AS DOUBLE) AS r
  FROM embeddings, unnest(generate_series(1, len(embedding))) AS t(i)
),
curves AS (
  SELECT label, pos, min(r) AS r_min, avg(r) AS r_avg, max(r) AS r_max FROM points GROUP BY 1, 2
),
knots AS (
  SELECT label, 0 AS dataset, pos / 100.0::DOUBLE AS q, r_min AS r FROM curves
  UNION ALL SELECT label, 1, pos / 100.0::DOUBLE, r_avg FROM curves
  UNION ALL SELECT label, 2, pos / 100.0::DOUBLE, r_max FROM curves
),
segments AS (
  SELECT *, lag(q) OVER w AS q0, lag(r) OVER w AS r0 FROM knots
  WINDOW w AS (PARTITION BY label, dataset ORDER BY q)
),
errors AS (
  SELECT p.vec_id, s.dataset,
    avg(abs(CASE WHEN s.q0 IS NULL THEN s.r
            ELSE s.r0 + ((p.pos + 0.5::DOUBLE) / 100.0::DOUBLE - s.q0) / (s.q - s.q0) * (s.r - s.r0) END - p.r)
        / greatest(abs(p.r), 1e-12::DOUBLE)) AS score
  FROM points p JOIN segments s ON s.label = p.label
   AND (p.pos + 0.5::DOUBLE) / 100.0::DOUBLE <= s.q AND (p.pos + 0.5::DOUBLE) / 100.0::DOUBLE > s.q0
  GROUP BY 1, 2
),
winners AS (
  SELECT vec_id, min(score) AS score, arg_min(dataset, struct_pack(s := score, d := dataset)) AS dataset
  FROM errors GROUP BY 1
)
SELECT vec_id, CAST(dataset AS INTEGER) AS dataset, round(score, 6) AS score,
       CASE WHEN score < 0.5 THEN CAST(dataset AS INTEGER) END AS matched
FROM winners
"""


@query("curve_match", _MATCH_SQL)
def curve_match_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector, as a measured curve, against the datasets of its label's model.

    A model has three probes: lowest, mean and highest value per position; the
    last one is listed from high to low q.
    """
    vectors = load(spark, sf_dir, "embeddings")
    positions = vectors.select("label", F.posexplode("embedding").alias("pos", "v")).select(
        "label", (F.col("pos") + 1).alias("pos"), (2 + F.col("v").cast("double")).alias("r")
    )
    per_position = positions.groupBy("label", "pos").agg(
        F.min("r").alias("low"), F.avg("r").alias("mean"), F.max("r").alias("high")
    )
    # A model has one knot per vector position, however many vectors there are.
    lines = per_position.groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("pos", "low", "mean", "high"))).alias("k")
    )
    grid = F.transform("k", lambda k: k["pos"] / F.lit(100.0))
    models = lines.select(
        "label",
        F.array(
            curve_match.probe(grid, F.col("k.low")),
            curve_match.probe(grid, F.col("k.mean")),
            curve_match.probe(F.reverse(grid), F.reverse(F.col("k.high"))),
        ).alias("probes"),
    )
    runs = vectors.select(
        "vec_id",
        "label",
        F.transform("embedding", lambda v, i: (i + 1.5) / F.lit(100.0)).alias("q"),
        F.transform("embedding", lambda v: 2 + v.cast("double")).alias("r"),
    )
    winner = curve_match.best(curve_match.scores(F.col("q"), F.col("r"), F.col("probes")))
    best = runs.join(models, "label").select("vec_id", F.inline(F.array(winner)))
    return best.select(
        "vec_id",
        "dataset",
        F.round("score", 6).alias("score"),
        curve_match.matched_dataset(F.struct("score", "dataset")).alias("matched"),
    )


# Datasets of the models below: the mean curve, moved up by quarters.
SHIFTS = 12

_CLOSEST_SQL = f"""
WITH points AS (
  SELECT vec_id, label, i AS pos, 2 + CAST(embedding[i] AS DOUBLE) + vec_id % 5 AS r
  FROM embeddings, unnest(generate_series(1, len(embedding))) AS t(i)
),
means AS (SELECT label, pos, avg(r - vec_id % 5) AS r FROM points GROUP BY 1, 2),
lines AS (SELECT label, pos / 100.0::DOUBLE AS q, r, lag(r) OVER (PARTITION BY label ORDER BY pos) AS r0 FROM means),
errors AS (
  SELECT p.vec_id, d AS dataset,
    avg(abs((l.r0 + l.r) / 2 + d / 4.0::DOUBLE - p.r) / greatest(abs(p.r), 1e-12::DOUBLE)) AS score
  FROM points p JOIN lines l ON l.label = p.label AND l.q = (p.pos + 1) / 100.0::DOUBLE, generate_series(0, {SHIFTS - 1}) AS t(d)
  WHERE l.r0 IS NOT NULL GROUP BY 1, 2
)
SELECT vec_id, CAST(arg_min(dataset, struct_pack(s := score, d := dataset)) AS INTEGER) AS dataset,
  round(min(score), 6) AS score, {SHIFTS} AS usable
FROM errors GROUP BY 1
"""


@query("closest_dataset", _CLOSEST_SQL)
def closest_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector, moved up by its number, against the moved means of its label."""
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    values = vectors.select("label", F.posexplode("embedding").alias("i", "v"))
    means = values.groupBy("label", "i").agg(F.avg(2 + F.col("v").cast("double")).alias("r"))
    # A model has one knot per vector position, however many vectors there are.
    lines = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "r"))).alias("k"))
    grid = F.transform("k", lambda k: (k["i"] + 1) / F.lit(100.0))
    shifted = F.transform(
        F.sequence(F.lit(0), F.lit(SHIFTS - 1)),
        lambda d: curve_match.probe(grid, F.transform("k", lambda k: k["r"] + d / F.lit(4.0))),
    )
    models = composed(lines, F.col("label"), shifted.alias("probes"))
    moved = F.col("vec_id") % 5
    runs = vectors.select(
        "vec_id",
        "label",
        F.transform("embedding", lambda v, i: (i + 1.5) / F.lit(100.0)).alias("q"),
        F.transform("embedding", lambda v: 2 + v.cast("double") + moved).alias("r"),
    )
    found = runs.join(models, "label").select(
        "vec_id", F.inline(F.array(curve_match.closest(F.col("q"), F.col("r"), F.col("probes"))))
    )
    return found.select("vec_id", "dataset", F.round("score", 6).alias("score"), "usable")


# --- checks -------------------------------------------------------------------

_CHECKS_SQL = """
WITH c AS (
  SELECT doc_id, list_transform(string_split(text, ' '), lambda x: length(x) / 1000.0::DOUBLE) AS q,
         list_transform(string_split(text, chr(10)), lambda x: CAST(length(x) AS DOUBLE)) AS dr
  FROM documents
)
SELECT doc_id, len(q) AS num_points, list_min(q) AS q_min, list_max(q) AS q_max,
  array_to_string(list_filter([
    CASE WHEN len(q) <> len(dr) THEN
      printf('Columns differ in length: q %d, r %d, dr %d, dq %d', len(q), len(q), len(dr), len(q)) END,
    CASE WHEN len(q) < 10 THEN printf('A curve of only %d points', len(q)) END,
    CASE WHEN list_max(q) < 0.01 THEN
      printf('All q are small: %.4f to %.4f', list_min(q), list_max(q)) END],
    lambda x: x IS NOT NULL), '; ') AS warnings,
  len(q) AS summary_length, round(list_sum(q[1:7]), 6) AS head_sum
FROM c
"""


@query("curve_checks", _CHECKS_SQL)
def curve_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of curves made of word and line lengths of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    c = docs.select(
        "doc_id",
        F.transform(F.split("text", " "), lambda w: F.length(w) / F.lit(1000.0)).alias("q"),
        F.transform(F.split("text", "\n"), lambda w: F.length(w).cast("double")).alias("dr"),
    )
    q = F.col("q")
    low, high = curves.q_range(q)
    summary = curves.array_summary(q, first=7)
    return c.select(
        "doc_id",
        curves.num_points(q).cast("bigint").alias("num_points"),
        low.alias("q_min"),
        high.alias("q_max"),
        F.array_join(curves.curve_warnings(q, q, F.col("dr"), q), "; ").alias("warnings"),
        summary["length"].cast("bigint").alias("summary_length"),
        F.round(
            F.aggregate(summary["first_values"], F.lit(0.0), lambda a, x: a + x), 6
        ).alias("head_sum"),
    )


# --- curve files --------------------------------------------------------------

_ROWS_SQL = r"""
WITH content AS (
  SELECT doc_id, text || chr(13) || chr(10) || '# note ' || lang || chr(10)
    || '  ' || doc_id || '.5 ' || n_chars || chr(9) || '1e-3 +.25 extra' || chr(10)
    || n_chars || ' 2 3' || chr(10)
    || CASE lang WHEN 'en' THEN doc_id || ' 1_0 2 3' WHEN 'fr' THEN doc_id || ' 1.0d 2 3'
       WHEN 'de' THEN doc_id || ' 0x10 2 3' ELSE doc_id || ' -5. 2 3' END AS content
  FROM documents
),
lines AS (
  SELECT doc_id, unnest(list_filter(list_transform(
    string_split(regexp_replace(content, '\r\n?', chr(10), 'g'), chr(10)),
    lambda x: regexp_replace(x, '^[\s\x{b}\x{85}\p{Z}]+|[\s\x{b}\x{85}\p{Z}]+$', '', 'g')),
    lambda x: x <> '')) AS line
  FROM content
),
tokens AS (
  SELECT doc_id, line LIKE '#%' AS is_header,
    CASE WHEN line LIKE '#%' THEN [] ELSE regexp_split_to_array(line, '[\s\x{b}\x{85}\p{Z}]+') END AS t
  FROM lines
),
parsed AS (
  SELECT doc_id, is_header, len(t) AS n, list_transform(t[1:4], lambda x:
    CASE WHEN regexp_matches(x, '^[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$')
         THEN CAST(replace(x, '_', '') AS DOUBLE) END) AS v
  FROM tokens
)
SELECT doc_id, count(*) FILTER (is_header) AS header_lines,
  count(*) FILTER (n >= 4 AND len(list_filter(v, lambda x: x IS NULL)) = 0) AS points,
  round(coalesce(sum(v[1]) FILTER (n >= 4 AND len(list_filter(v, lambda x: x IS NULL)) = 0), 0), 6) AS q_sum,
  round(coalesce(sum(v[2]) FILTER (n >= 4 AND len(list_filter(v, lambda x: x IS NULL)) = 0), 0), 6) AS r_sum,
  round(coalesce(sum(v[4]) FILTER (n >= 4 AND len(list_filter(v, lambda x: x IS NULL)) = 0), 0), 6) AS dq_sum
FROM parsed GROUP BY doc_id
"""


@query("curve_rows_from_text", _ROWS_SQL)
def curve_rows_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines and number rows found in every document with rows added."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    number, chars = F.col("doc_id"), F.col("n_chars")
    content = text(
        F.col("text"), "\r\n# note ", F.col("lang"), "\n  ", number, ".5 ", chars,
        "\t1e-3 +.25 extra\n", chars, " 2 3\n",
        F.when(F.col("lang") == "en", text(number, " 1_0 2 3"))
        .when(F.col("lang") == "fr", text(number, " 1.0d 2 3"))
        .when(F.col("lang") == "de", text(number, " 0x10 2 3"))
        .otherwise(text(number, " -5. 2 3")),
    )
    texts = composed(docs, number.alias("doc_id"), content.alias("content"))
    lines = texts.select("doc_id", reduced_text.split_lines(F.col("content")).alias("lines"))
    rows = lines.select(
        "doc_id",
        F.size(F.filter("lines", lambda x: F.startswith(x, F.lit("#")))).alias("header_lines"),
        reduced_text.curve_points(F.col("lines")).alias("p"),
    )

    def total(name: str):
        values = F.col("p")[name]
        return F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6).alias(f"{name}_sum")

    return rows.select(
        "doc_id",
        F.col("header_lines").cast("bigint").alias("header_lines"),
        F.size("p").cast("bigint").alias("points"),
        total("q"),
        total("r"),
        total("dq"),
    )


_HEADER_SQL = """
SELECT o_orderkey, 'IPTS-' || o_custkey AS experiment_id, o_orderkey AS run_number,
  CASE WHEN o_orderstatus = 'P' THEN 'Run title:' ELSE '2.' || o_custkey || '.dev1' END AS reduction_version,
  CASE WHEN o_orderstatus = 'P' THEN '' || o_orderpriority ELSE 'title ' || o_orderpriority END AS run_title,
  epoch_us(o_orderdate) + 244352 AS start_us,
  epoch_us(o_orderdate) + 63041000000 AS reduced_us,
  CASE WHEN o_orderstatus <> 'F' THEN 'IPTS-' || (o_custkey + 1) END AS meta_experiment,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderkey + 7 AS VARCHAR) END AS meta_run,
  CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS meta_price,
  CAST(2 AS BIGINT) AS angles,
  round(o_custkey / 4.0::DOUBLE + 0.5, 6) AS angle_sum,
  CAST(2 AS BIGINT) AS points
FROM orders
"""


def curve_texts(orders: DataFrame) -> DataFrame:
    """One curve file per order; status decides what is odd about its header."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    meta = F.when(status == "F", F.lit("# Meta:{not valid json,,,")).otherwise(
        text(
            '# Meta:{"experiment": "IPTS-', customer + 1, '", "run_number": ', key + 7,
            ', "price": ', F.col("o_totalprice"), "}",
        )
    )
    title = F.when(
        status == "P", text("# Reduction\n# Run title:\n# ", F.col("o_orderpriority"))
    ).otherwise(
        text("# Reduction 2.", customer, ".dev1\n# Run title: title ", F.col("o_orderpriority"))
    )
    content = text(
        "# Experiment IPTS-", customer, "\n# Run ", key, "\n", title,
        "\n# Run start time: ", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), ".244352667",
        "\n# Reduction time: ", F.date_format(day + F.expr("INTERVAL '17:30:41' HOUR TO SECOND"), "EEE MMM dd HH:mm:ss yyyy"),
        "\n", meta, "\n# DataRun NormRun TwoTheta\n# ", key, " 17 ", customer / 4.0, " 2.5\n#  7 8\t0.5\n",
        "0.1 1.5 0.01 0.001\r\n\n  0.2 1.25 0.01 0.002\n",
    )
    path = text("/IPTS-", customer, "/curves/REFL_", key, ".txt")
    return composed(orders, key.alias("o_orderkey"), path.alias("path"), content.alias("content"))


@query("header_fields", _HEADER_SQL)
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header fields, Meta block and run table of one curve file per order."""
    orders = load(spark, sf_dir, "orders")
    read = reduced_text.parse(curve_texts(orders))
    return read.select(
        "o_orderkey",
        "experiment_id",
        "run_number",
        "reduction_version",
        "run_title",
        F.unix_micros("run_start_time").alias("start_us"),
        F.unix_micros("reduction_time").alias("reduced_us"),
        F.col("meta_fields.experiment").alias("meta_experiment"),
        F.col("meta_fields.run_number").alias("meta_run"),
        F.try_variant_get("meta", "$.price", "double").alias("meta_price"),
        F.size("two_theta").cast("bigint").alias("angles"),
        F.round(F.aggregate("two_theta", F.lit(0.0), lambda a, x: a + x), 6).alias("angle_sum"),
        F.size("q").cast("bigint").alias("points"),
    )


_TIMES_SQL = "SELECT o_orderkey, CASE o_orderkey % 7 WHEN 6 THEN NULL ELSE epoch_us(o_orderdate) + 45296000000 END AS start_us FROM orders"


@query("header_times", _TIMES_SQL)
def header_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start times in the spellings that occur in headers."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    moment = F.col("o_orderdate") + F.expr("INTERVAL '12:34:56' HOUR TO SECOND")
    shapes = (
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
        "yyyy-MM-dd HH:mm:ss.SSSSSS",
        "EEE MMM d HH:mm:ss yyyy",
        "yyyyMMdd'T'HHmmss",
        "EEEE, d MMM yyyy HH:mm:ss",
        "MM/dd/yyyy HH:mm:ss",
    )
    spelled = F.lit("soon")
    for i, shape in enumerate(shapes):
        spelled = F.when(F.col("o_orderkey") % 7 == i, F.date_format(moment, shape)).otherwise(spelled)
    texts = composed(orders, F.col("o_orderkey"), spelled.alias("start"))
    return texts.select("o_orderkey", F.unix_micros(any_time(F.col("start"))).alias("start_us"))


# --- conditions ---------------------------------------------------------------

_SENTENCE_SQL = """CASE event_type
  WHEN 'click' THEN 'Held at ' || (event_id % 5 - 2) || '.5 V vs RHE in 0.' || (event_id % 9 + 1) || ' M KOH'
  WHEN 'view' THEN 'OCV measurement in D2O (pH ' || (event_id % 14) || '.25, 0.1 M NaHCO3), 0.2 V'
  WHEN 'error' THEN 'she set −' || (event_id % 3) || ' V against Ag / AgCl; PH=' || (event_id % 14)
  WHEN 'signup' THEN 'Open-circuit, 2 M H2SO4'
  ELSE 'Dry film, ' || user_id || ' V2, measured in air' END"""

_EVENT_CONDITIONS_SQL = f"""
WITH t AS (SELECT *, {_SENTENCE_SQL} AS s FROM events)
SELECT event_id,
  CASE WHEN event_type IN ('view', 'signup') THEN 'open_circuit'
       WHEN event_type IN ('click', 'error') THEN 'potentiostatic' END AS control_mode,
  CASE event_type WHEN 'click' THEN CAST((event_id % 5 - 2) || '.5' AS DOUBLE)
                  WHEN 'error' THEN -CAST(event_id % 3 AS DOUBLE) END AS potential,
  CASE event_type WHEN 'click' THEN 'RHE' WHEN 'error' THEN 'Ag/AgCl' END AS potential_scale,
  CASE event_type WHEN 'view' THEN event_id % 14 + 0.25::DOUBLE
                  WHEN 'error' THEN CAST(event_id % 14 AS DOUBLE) END AS ph,
  CASE event_type WHEN 'click' THEN 'KOH' WHEN 'view' THEN 'NaHCO3)' WHEN 'signup' THEN 'H2SO4' END AS electrolyte,
  CASE event_type WHEN 'click' THEN CAST('0.' || (event_id % 9 + 1) AS DOUBLE)
                  WHEN 'view' THEN 0.1::DOUBLE WHEN 'signup' THEN 2.0::DOUBLE END AS molar
FROM t
"""


def _condition_columns(found):
    return [
        found["control_mode"].alias("control_mode"),
        found["potential"].alias("potential"),
        found["potential_scale"].alias("potential_scale"),
        found["pH"].alias("ph"),
        found["electrolyte"]["name"].alias("electrolyte"),
        found["electrolyte"]["concentration_M"].alias("molar"),
    ]


def event_sentence():
    """A description per event; its kind decides what it mentions."""
    n = F.col("event_id")
    return (
        F.when(
            F.col("event_type") == "click",
            text("Held at ", n % 5 - 2, ".5 V vs RHE in 0.", n % 9 + 1, " M KOH"),
        )
        .when(
            F.col("event_type") == "view",
            text("OCV measurement in D2O (pH ", n % 14, ".25, 0.1 M NaHCO3), 0.2 V"),
        )
        .when(
            F.col("event_type") == "error",
            text("she set −", n % 3, " V against Ag / AgCl; PH=", n % 14),
        )
        .when(F.col("event_type") == "signup", F.lit("Open-circuit, 2 M H2SO4"))
        .otherwise(text("Dry film, ", F.col("user_id"), " V2, measured in air"))
    )


@query("text_conditions", _EVENT_CONDITIONS_SQL)
def text_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions from one description per event."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    described = composed(events, F.col("event_id"), event_sentence().alias("s"))
    return described.select("event_id", conditions.conditions(F.col("s")).alias("c")).select("event_id", *_condition_columns(F.col("c")))


_DOC_CONDITIONS_SQL = r"""
WITH t AS (
  SELECT doc_id, text || ' Held at ' || (n_chars % 3) || '.25 V vs ' ||
    CASE lang WHEN 'en' THEN 'NHE' WHEN 'fr' THEN 'SCE' WHEN 'de' THEN 'hg/HgO' ELSE 'the wire' END ||
    CASE WHEN source LIKE '%1' THEN ' at ocv' ELSE '' END || ', pH ' || (doc_id % 14) || ' with 1.5 M LiCl(aq)' AS s
  FROM documents
),
f AS (
  SELECT doc_id, s,
    regexp_matches(s, '(?i)(^|[^\p{L}\p{N}_])OC[VP]([^\p{L}\p{N}_]|$)|open[\s-]?circuit') AS is_open,
    nullif(regexp_extract(s, '([+\-−]?\d+(\.\d+)?)\s*V($|[^\p{L}\p{N}_])', 1), '') AS volts
  FROM t
)
SELECT doc_id,
  CASE WHEN is_open THEN 'open_circuit' WHEN volts IS NOT NULL THEN 'potentiostatic' END AS control_mode,
  CASE WHEN NOT is_open THEN CAST(replace(volts, '−', '-') AS DOUBLE) END AS potential,
  CASE WHEN is_open OR volts IS NULL THEN NULL
       WHEN regexp_matches(s, '(^|[^\p{L}\p{N}_])RHE([^\p{L}\p{N}_]|$)') THEN 'RHE'
       WHEN regexp_matches(s, '(^|[^\p{L}\p{N}_])SHE([^\p{L}\p{N}_]|$)') THEN 'SHE'
       WHEN regexp_matches(s, '(^|[^\p{L}\p{N}_])NHE([^\p{L}\p{N}_]|$)') THEN 'SHE'
       WHEN regexp_matches(s, '(^|[^\p{L}\p{N}_])SCE([^\p{L}\p{N}_]|$)') THEN 'SCE'
       WHEN regexp_matches(s, '(?i)Ag\s*/\s*AgCl') THEN 'Ag/AgCl'
       WHEN regexp_matches(s, '(?i)Hg\s*/\s*HgSO4') THEN 'Hg/HgSO4'
       WHEN regexp_matches(s, '(?i)Hg\s*/\s*HgO') THEN 'Hg/HgO'
       ELSE 'SHE' END AS potential_scale,
  CAST(nullif(regexp_extract(s, '(?i)(^|[^\p{L}\p{N}_])pH\s*=?\s*(\d+(\.\d+)?)', 2), '') AS DOUBLE) AS ph,
  nullif(regexp_extract(s, '(\d+(\.\d+)?)\s*M\s+([A-Za-z][A-Za-z0-9()]*)', 3), '') AS electrolyte,
  CAST(nullif(regexp_extract(s, '(\d+(\.\d+)?)\s*M\s+([A-Za-z][A-Za-z0-9()]*)', 1), '') AS DOUBLE) AS molar
FROM f
"""


@query("document_conditions", _DOC_CONDITIONS_SQL)
def document_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions from whole documents with a description at their end."""
    docs = load(spark, sf_dir, "documents")
    scale = (
        F.when(F.col("lang") == "en", F.lit("NHE"))
        .when(F.col("lang") == "fr", F.lit("SCE"))
        .when(F.col("lang") == "de", F.lit("hg/HgO"))
        .otherwise(F.lit("the wire"))
    )
    resting = F.when(F.col("source").endswith("1"), F.lit(" at ocv")).otherwise(F.lit(""))
    described = text(
        F.col("text"), " Held at ", F.col("n_chars") % 3, ".25 V vs ", scale, resting,
        ", pH ", F.col("doc_id") % 14, " with 1.5 M LiCl(aq)",
    )
    found = composed(docs, F.col("doc_id"), described.alias("s")).select(
        "doc_id", conditions.conditions(F.col("s")).alias("c")
    )
    return found.select("doc_id", *_condition_columns(F.col("c")))
