"""Queries over service logs, metric exposition, notebooks and images."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelpulse.functions import scalar as S
from modelpulse.operators import batching as B
from modelpulse.operators import images as I
from modelpulse.operators import notebooks as N
from modelpulse.operators import requests as R
from modelpulse.operators import traces as TR
from modelpulse.plans.inference import BATCHES, assigned_batches
from modelpulse.plans.registry import REQUESTS, histogram_sql, query, with_requests
from modelpulse.session import scratch_path
from modelpulse.sources import artifacts as A
from modelpulse.sources import exposition as X
from modelpulse.sources import logs as L
from modelpulse.sources.tables import load, load_texts, requests, requests_from_events


def _records(spark, sf_dir):
    """One log record per request; every tenth line has no request id, levels come in mixed forms."""
    log = requests_from_events(load_texts(spark, sf_dir, "events"))
    k = F.col("k")
    failed = F.col("error_type").isNotNull()
    record = L.log_record(
        ts=F.col("start_ts"),
        name=F.concat(F.lit("serving"), F.col("endpoint")),
        message=F.when(failed, F.lit(TR.FAILED)).otherwise(F.lit(TR.COMPLETED)),
        level=F.when(k % 4 == 0, "info").when(k % 4 == 1, ""),
        record_level=F.when(failed, "ERROR").otherwise("INFO"),
        request_id=F.when(k % 10 != 0, S.short_id(F.col("request_id"))),
        source=(F.lit("api.py"), k, F.lit("predict")),
        exception=(F.col("error_type"), F.concat(F.lit("code "), F.col("status").cast("string")), F.lit("trace")),
        operation=F.col("event_type"),
        duration_ms=F.col("latency_ms"),
        status=F.when(failed, "failed").otherwise("success"),
        error_type=F.col("error_type"),
    )
    return L.json_lines(log, record, extras=F.create_map(F.lit("user_id"), F.col("user_id").cast("string")))


RECORDS = """
records AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp,
         CASE WHEN k % 4 = 0 THEN 'INFO' WHEN error_type IS NOT NULL THEN 'ERROR' ELSE 'INFO' END AS level,
         'serving' || endpoint AS name,
         CASE WHEN error_type IS NOT NULL THEN 'Request failed' ELSE 'Request completed successfully' END AS message,
         'resnet-serving' AS service, 'development' AS environment,
         CASE WHEN k % 10 <> 0 THEN substr(md5(CAST(request_id AS VARCHAR)), 1, 8) ELSE 'no-request-id' END AS request_id,
         'api.py' AS source_file, CAST(k AS INTEGER) AS source_line,
         error_type AS exception_type, CASE WHEN error_type IS NOT NULL THEN 'code ' || status END AS exception_message,
         event_type AS operation, latency_ms AS duration_ms,
         CASE WHEN error_type IS NOT NULL THEN 'failed' ELSE 'success' END AS status, error_type,
         CAST(user_id AS VARCHAR) AS user_id
  FROM requests)
"""


@query(with_requests(f", {RECORDS} SELECT * FROM records"))
def service_log_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "service-log")
    L.write_lines(_records(spark, sf_dir), path)
    read = L.read_json_logs(spark, path)
    return read.select(
        "timestamp", "level", "name", "message", "service", "environment", "request_id",
        F.col("source.file").alias("source_file"), F.col("source.line").alias("source_line"),
        F.col("exception.type").alias("exception_type"), F.col("exception.message").alias("exception_message"),
        "operation", "duration_ms", "status", "error_type",
        F.element_at("extras", "user_id").alias("user_id"),
    )


@query(with_requests(f", {RECORDS} SELECT name, level, count(*) AS n FROM records WHERE level IN ('ERROR') GROUP BY name, level"))
def log_level_filter(spark, sf_dir):
    loud = L.at_level(L.parse_json_lines(_records(spark, sf_dir)), "WARNING")
    return loud.groupBy("name", "level").agg(F.count(F.lit(1)).alias("n"))


@query(
    with_requests(
        f""", {RECORDS}
SELECT operation, status, count(*) AS n, round(avg(duration_ms), 6) AS mean_ms, max(duration_ms) AS max_ms,
       coalesce(string_agg(DISTINCT error_type, ',' ORDER BY error_type), '') AS error_types
FROM records GROUP BY operation, status"""
    )
)
def span_summary(spark, sf_dir):
    return TR.span_summary(L.parse_json_lines(_records(spark, sf_dir)))


@query(
    with_requests(
        """,
ids AS (SELECT *, md5(CAST(request_id AS VARCHAR)) AS rid FROM requests WHERE k % 10 <> 0),
lines AS (SELECT rid, 'received' AS stage, start_us AS at_us FROM ids
          UNION ALL SELECT rid, 'queued', start_us + k * 100 FROM ids
          UNION ALL SELECT rid, CASE WHEN status = 200 THEN 'completed' ELSE 'failed' END, end_us + k * 100 FROM ids),
staged AS (SELECT rid AS request_id, min(at_us) FILTER (stage = 'received') AS received_us, min(at_us) FILTER (stage = 'queued') AS queued_us,
                  min(at_us) FILTER (stage IN ('completed', 'failed')) AS done_us, count(*) AS lines,
                  CASE WHEN bool_or(stage = 'failed') THEN 'failed' ELSE 'completed' END AS result FROM lines GROUP BY rid)
SELECT *, (queued_us - received_us) / 1000.0 AS to_queue_ms, (done_us - queued_us) / 1000.0 AS in_queue_ms FROM staged"""
    )
)
def request_traces(spark, sf_dir):
    log = requests(spark, sf_dir)
    wait = F.col("k") * 100

    def line(message, at):
        return F.struct(message.alias("message"), at.alias("at_us"))

    done = F.when(F.col("status") == 200, TR.COMPLETED).otherwise(TR.FAILED)
    lines = log.select(
        S.request_id_or_default(F.when(F.col("k") % 10 != 0, F.md5(F.col("request_id").cast("string")))).alias("request_id"),
        F.inline(
            F.array(
                line(F.lit(TR.RECEIVED), F.col("start_us")),
                line(F.lit(TR.QUEUED), F.col("start_us") + wait),
                line(done, F.col("end_us") + wait),
            )
        ),
    )
    return TR.request_traces(lines)


def _text_lines(spark, sf_dir):
    log = requests(spark, sf_dir)
    message = F.when(
        F.col("event_type") == "view",
        F.concat(F.lit("Processing batch of size "), (1 + F.col("k") % 8).cast("string")),
    ).otherwise(F.format_string("Batch inference completed in %.2fms", F.col("latency_ms")))
    trace = F.concat(F.lit("\nTraceback (most recent call last):\n  "), F.col("error_type"))
    message = F.concat(message, F.coalesce(trace, F.lit("")))
    return L.text_lines(
        log,
        F.col("start_ts"),
        F.concat(F.lit("batch_manager"), F.col("endpoint")),
        F.when(F.col("error_type").isNull(), "INFO").otherwise("ERROR"),
        F.when(F.col("k") % 10 != 0, S.short_id(F.col("request_id"))),
        message,
    )


TEXT_LOG = """
lines AS (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S,%g') AS time, 'batch_manager' || endpoint AS name,
         CASE WHEN error_type IS NULL THEN 'INFO' ELSE 'ERROR' END AS level,
         CASE WHEN k % 10 <> 0 THEN substr(md5(CAST(request_id AS VARCHAR)), 1, 8) ELSE 'no-request-id' END AS request_id,
         CASE WHEN event_type = 'view' THEN 'Processing batch of size ' || (1 + k % 8)
              ELSE printf('Batch inference completed in %.2fms', latency_ms) END
         || coalesce(chr(10) || 'Traceback (most recent call last):' || chr(10) || '  ' || error_type, '') AS message
  FROM requests)
"""


@query(with_requests(f", {TEXT_LOG} SELECT * FROM lines"))
def text_log_scan(spark, sf_dir):
    path = scratch_path(spark, "text-log")
    L.write_lines(_text_lines(spark, sf_dir), path)
    return L.read_text_logs(spark, path).drop("raw")


@query(
    with_requests(
        """ SELECT raw, count(*) AS n FROM (
  SELECT unnest(['Traceback (most recent call last):', '  ' || error_type]) AS raw FROM requests WHERE error_type IS NOT NULL) GROUP BY raw"""
    )
)
def unparsed_log_lines(spark, sf_dir):
    """Physical lines that are no record of their own."""
    physical = _text_lines(spark, sf_dir).select(F.explode(F.split("value", "\n")).alias("value"))
    return L.parse_text_lines(physical).where(F.col("raw").isNotNull()).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))


@query(
    with_requests(
        f""", {TEXT_LOG},
mined AS (SELECT name, CAST(nullif(regexp_extract(message, 'Processing batch of size ([0-9]+)', 1), '') AS BIGINT) AS s,
                 CAST(nullif(regexp_extract(message, 'completed in ([0-9]+[.][0-9]+)ms', 1), '') AS DOUBLE) AS ms FROM lines)
SELECT name, count(s) AS batches, CAST(sum(s) AS BIGINT) AS items, round(avg(s), 6) AS mean_size,
       count(ms) AS timed, round(avg(ms), 6) AS mean_ms, max(ms) AS max_ms FROM mined GROUP BY name"""
    )
)
def batch_log_mining(spark, sf_dir):
    return TR.mine_batches(L.parse_text_lines(_text_lines(spark, sf_dir)))


# Name, kind, help text and labels of the metric families.
FAMILIES = [
    ("http_requests_total", "counter", "Total HTTP requests", ["method", "endpoint", "status"]),
    ("http_request_duration_seconds", "histogram", "HTTP request duration in seconds", ["method", "endpoint"]),
    ("http_request_size_bytes", "histogram", "HTTP request size in bytes", ["method", "endpoint"]),
    ("http_response_size_bytes", "histogram", "HTTP response size in bytes", ["method", "endpoint"]),
    ("model_inference_duration_seconds", "histogram", "Model inference duration in seconds", ["model_name"]),
    ("batch_size", "histogram", "Number of requests in batch", []),
    ("batch_queue_length", "gauge", "Current length of batch queue", []),
    ("errors_total", "counter", "Total errors", ["error_type", "endpoint"]),
    ("active_requests", "gauge", "Number of requests currently being processed", []),
    ("model_load_time_seconds", "gauge", "Time taken to load the model", []),
]


def _family_sql(name, kind, help_text, labels):
    """Header and sample lines of a family whose samples are the table of its name."""
    pairs = {n: f"""'{n}="' || {n} || '"'""" for n in labels}
    if kind == "histogram":
        pairs["le"] = """CASE WHEN le <> '' THEN 'le="' || le || '"' END"""
    series = f"concat_ws(',', {', '.join(pairs[n] for n in sorted(pairs))})" if pairs else "''"
    metric = f"'{name}_' || sample" if kind == "histogram" else f"'{name}'"
    return f"""SELECT '# HELP {name} {help_text}' AS value UNION ALL SELECT '# TYPE {name} {kind}'
  UNION ALL SELECT {metric} || CASE series WHEN '' THEN '' ELSE '{{' || series || '}}' END || ' ' || CAST(CAST(value AS DOUBLE) AS VARCHAR)
  FROM (SELECT *, {series} AS series FROM {name})"""


# Sizes are told by the payload number of a request, the load time by the first request, which waits for the model.
EXPOSITION = f"""{REQUESTS}, {BATCHES},
page AS (SELECT *, 'resnet50' AS model_name, latency_ms / 100.0 AS seconds, inference_ms / 100.0 AS busy,
                k * 1024.0 AS bytes_in, k * 4096.0 AS bytes_out FROM requests),
sized AS (SELECT CAST(count(*) AS DOUBLE) AS items FROM batches GROUP BY endpoint, batch_tick),
http_requests_total AS (SELECT method, endpoint, status, count(*) AS value FROM page GROUP BY ALL),
http_request_duration_seconds AS ({histogram_sql("page", "method, endpoint", "seconds", R.DURATION_BOUNDS)}),
http_request_size_bytes AS ({histogram_sql("page", "method, endpoint", "bytes_in", R.BYTE_BOUNDS)}),
http_response_size_bytes AS ({histogram_sql("page", "method, endpoint", "bytes_out", R.BYTE_BOUNDS)}),
model_inference_duration_seconds AS ({histogram_sql("page", "model_name", "busy", R.INFERENCE_BOUNDS)}),
batch_size AS ({histogram_sql("sized", "", "items", R.BATCH_BOUNDS)}),
batch_queue_length AS (SELECT arg_max(k, (ts, request_id)) AS value FROM page),
errors_total AS (SELECT error_type, endpoint, count(*) AS value FROM page WHERE error_type IS NOT NULL GROUP BY ALL),
active_requests AS (SELECT arg_max(active, at_us) AS value FROM (
  SELECT at_us, sum(sum(change)) OVER (ORDER BY at_us) AS active FROM (
    SELECT start_us AS at_us, 1 AS change FROM page UNION ALL SELECT end_us, -1 FROM page) GROUP BY at_us)),
model_load_time_seconds AS (SELECT round(arg_min(seconds, (ts, request_id)), 4) AS value FROM page),
lines AS ({" UNION ALL ".join(_family_sql(*family) for family in FAMILIES)})
"""


def _exposition(spark, sf_dir):
    log = requests(spark, sf_dir).withColumn("model_name", F.lit("resnet50"))
    served = ["method", "endpoint"]
    sizes = B.batch_sizes(assigned_batches(spark, sf_dir), ["endpoint"])
    first = F.min_by(F.col("latency_ms") / F.lit(100.0), F.struct("start_us", "request_id"))
    samples = {
        "http_requests_total": R.request_counter(log),
        "http_request_duration_seconds": R.histogram(log, served, F.col("latency_ms") / F.lit(100.0), R.DURATION_BOUNDS),
        "http_request_size_bytes": R.histogram(log, served, F.col("k") * F.lit(1024.0), R.BYTE_BOUNDS),
        "http_response_size_bytes": R.histogram(log, served, F.col("k") * F.lit(4096.0), R.BYTE_BOUNDS),
        "model_inference_duration_seconds": R.histogram(log, ["model_name"], F.col("inference_ms") / F.lit(100.0), R.INFERENCE_BOUNDS),
        "batch_size": R.histogram(sizes, [], F.col("batch_size").cast("double"), R.BATCH_BOUNDS),
        "batch_queue_length": R.last_value_gauge(log, [], "k", "start_us", "request_id"),
        "errors_total": R.error_counter(log),
        "active_requests": R.concurrency_gauge(log, []).agg(F.max_by("active", "at_us").alias("value")),
        "model_load_time_seconds": log.agg(F.round(first, 4).alias("value")),
    }
    lines = None
    for name, kind, help_text, labels in FAMILIES:
        write = X.histogram_lines if kind == "histogram" else X.value_lines
        family = X.header_lines(spark, name, help_text, kind).unionByName(write(samples[name], name, labels))
        lines = family if lines is None else lines.unionByName(family)
    return lines


@query(f"WITH {EXPOSITION} SELECT value FROM lines")
def metric_exposition(spark, sf_dir):
    path = scratch_path(spark, "exposition")
    X.write_exposition(_exposition(spark, sf_dir), path)
    return spark.read.text(path)


@query(f"WITH {EXPOSITION} SELECT value FROM lines WHERE value NOT LIKE '#%' ORDER BY value LIMIT 5")
def first_metric_samples(spark, sf_dir):
    return X.first_samples(_exposition(spark, sf_dir).select("value"))


@query(
    f"""WITH {EXPOSITION}
SELECT regexp_extract(value, '^([a-z_]+)', 1) AS metric, count(*) AS samples,
       round(sum(CAST(regexp_extract(value, ' ([^ ]+)$', 1) AS DOUBLE)), 3) AS total
FROM lines WHERE value NOT LIKE '#%' GROUP BY 1"""
)
def parsed_metric_samples(spark, sf_dir):
    parsed = X.parse_samples(_exposition(spark, sf_dir))
    return parsed.groupBy("metric").agg(
        F.count(F.lit(1)).alias("samples"), F.round(F.sum("sample_value"), 3).alias("total")
    )


@query(
    with_requests(
        "SELECT endpoint, printf('%.2f%%', 100.0 * count(*) FILTER (status = 200) / count(*)) AS success FROM requests GROUP BY endpoint"
    )
)
def success_percent(spark, sf_dir):
    ok = F.count_if(R.succeeded()) / F.count(F.lit(1))
    return requests(spark, sf_dir).groupBy("endpoint").agg(S.percent(ok).alias("success"))


# A notebook per document: one cell per line, a marker and outputs chosen by the line's length.
MARKERS = ["Actual vs Predicted", "Confusion Matrix", "feature_importances", "Model Complexity", "CV Accuracy and Confusion Matrix"]


def _notebooks(spark, sf_dir):
    def cell(line):
        n = F.length(line)
        marker = F.lit("x = 1\n")
        for i, text in enumerate(MARKERS):
            marker = F.when(n % 8 == i, F.lit(f"title('{text}')\n")).otherwise(marker)

        def output(mime, text):
            return F.struct(F.create_map(F.lit(mime), text).alias("data"))

        def png(text):
            return output("image/png", F.base64(F.encode(text, "utf-8")))

        outputs = (
            F.when(n % 3 == 0, F.slice(F.array(output("text/plain", line)), 1, 0))
            .when(n % 3 == 1, F.array(output("text/plain", line)))
            .otherwise(F.array(png(line), output("text/plain", line), png(F.concat(F.lit("second "), line))))
        )
        return F.struct(F.array(marker, line).alias("source"), outputs.alias("outputs"))

    documents = load_texts(spark, sf_dir, "documents")
    return documents.select(
        F.col("doc_id").cast("string").alias("path"), F.transform(F.split("text", "\n"), cell).alias("cells")
    )


IMAGES = """
cells AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS cell_idx FROM documents),
outs AS (SELECT doc_id, cell_idx, line, 0 AS o, line AS body FROM cells WHERE length(line) % 3 = 2
         UNION ALL SELECT doc_id, cell_idx, line, 1, 'second ' || line FROM cells WHERE length(line) % 3 = 2),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cell_idx, o) AS n FROM outs),
sourced AS (SELECT *, CASE length(line) % 8 WHEN 0 THEN 'title(''Actual vs Predicted'')' WHEN 1 THEN 'title(''Confusion Matrix'')'
              WHEN 2 THEN 'title(''feature_importances'')' WHEN 3 THEN 'title(''Model Complexity'')'
              WHEN 4 THEN 'title(''CV Accuracy and Confusion Matrix'')' ELSE 'x = 1' END || line AS source FROM numbered),
images AS (SELECT CAST(doc_id AS VARCHAR) AS path, CAST(n AS INTEGER) AS n, CAST(cell_idx AS INTEGER) AS cell_idx, body,
  CASE WHEN contains(source, 'Actual vs Predicted') THEN '01_regression_actual_vs_predicted.png'
       WHEN contains(source, 'Confusion Matrix') THEN '02_classification_confusion_matrix.png'
       WHEN contains(source, 'feature_importances') THEN '03_feature_importances.png'
       WHEN contains(source, 'Model Complexity') OR contains(source, 'CV Accuracy') THEN '04_model_complexity_cv.png'
       ELSE 'plot_' || CASE WHEN n < 10 THEN '0' ELSE '' END || n || '.png' END AS filename FROM sourced)
"""


@query(f"WITH {IMAGES} SELECT path, n, cell_idx, filename, md5(body) AS digest FROM images")
def notebook_image_names(spark, sf_dir):
    images = N.image_outputs(_notebooks(spark, sf_dir))
    return images.select("path", "n", "cell_idx", "filename", F.md5("content").alias("digest"))


@query(
    f"""WITH {IMAGES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY path, filename ORDER BY n DESC) AS rn FROM images)
SELECT path, n, filename, md5(body) AS digest FROM ranked WHERE rn = 1"""
)
def notebook_artifacts(spark, sf_dir):
    """Notebook files are written and scanned, then their images go through the binary table sink."""
    files = scratch_path(spark, "notebooks")
    documents = _notebooks(spark, sf_dir).select(
        F.concat(F.col("path"), F.lit(".ipynb")).alias("filename"),
        F.encode(F.to_json(F.struct("cells")), "utf-8").alias("content"),
    )
    A.write_artifact_files(documents, files, shards=A.SHARDS)
    final = N.last_write_wins(N.image_outputs(A.read_notebooks(spark, files, recursive=True)))
    table = scratch_path(spark, "artifacts")
    A.write_artifact_table(final, table)
    stored = spark.read.parquet(table)
    return stored.select(
        F.regexp_extract("path", r"([^/]+)\.ipynb$", 1).alias("path"), "n", "filename", F.md5("content").alias("digest")
    )


@query(
    f"""WITH {IMAGES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY path, filename ORDER BY n DESC) AS rn FROM images)
SELECT path AS folder, filename, md5(body) AS digest, CAST(strlen(body) AS BIGINT) AS length FROM ranked WHERE rn = 1 AND strlen(body) > 0"""
)
def notebook_image_files(spark, sf_dir):
    """The images as files, in one folder per notebook, scanned back; a scan passes over empty files."""
    path = scratch_path(spark, "notebook-images")
    final = N.last_write_wins(N.image_outputs(_notebooks(spark, sf_dir)))
    A.write_artifact_files(final, path, folder="path", shards=A.SHARDS)
    scanned = A.read_image_bytes(spark, path, "*.png", recursive=True)
    named = lambda group: F.regexp_extract("path", r"([^/]+)/([^/]+)$", group)
    return scanned.select(named(1).alias("folder"), named(2).alias("filename"), F.md5("content").alias("digest"), "length")


# Header of an uncompressed 8 x 8 bitmap with 24 bits per pixel.
BITMAP_HEADER = (
    "424DF6000000000000003600000028000000" "0800000008000000" "0100180000000000C0000000" "00000000000000000000000000000000"
)


def _bitmaps(spark, sf_dir):
    """One small colour bitmap per vector, each value a pixel."""

    def pixel(x):
        byte = F.floor((x.cast("double") + 1) * 127.5).cast("int")
        shade, other = F.lpad(F.hex(byte), 2, "0"), F.lpad(F.hex(255 - byte), 2, "0")
        return F.concat(shade, other, shade)

    body = F.array_join(F.transform("embedding", pixel), "")
    return load(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("img_"), F.col("vec_id").cast("string"), F.lit(".bmp")).alias("filename"),
        F.unhex(F.concat(F.lit(BITMAP_HEADER), body)).alias("content"),
    )


@query("SELECT 'img_' || vec_id || '.bmp' AS filename, CAST(246 AS BIGINT) AS length FROM embeddings")
def image_bytes_scan(spark, sf_dir):
    path = scratch_path(spark, "images")
    A.write_artifact_files(_bitmaps(spark, sf_dir), path, shards=A.SHARDS)
    scanned = A.read_image_bytes(spark, path, "*.bmp", recursive=True)
    return scanned.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), "length")


# Resampling from 8 to 256 as a table of weights (two taps for each place of the crop), applied across, then down. Rows of a
# bitmap come from the bottom; blue and red are alike. A channel's checksum weighs every pixel by its place.
RESAMPLED = """
taps AS (SELECT o, i, 1 - abs(i + 0.5 - (o + 0.5) / 32) AS w FROM (SELECT unnest(range(16, 240)) AS o), (SELECT unnest(range(0, 8)) AS i) WHERE abs(i + 0.5 - (o + 0.5) / 32) < 1),
weights AS (SELECT o, min(i) AS i0, max(i) AS i1, min_by(w, i) / sum(w) AS w0, CASE WHEN count(*) > 1 THEN max_by(w, i) / sum(w) ELSE 0 END AS w1 FROM taps GROUP BY o),
bytes AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
pixels AS (SELECT vec_id, c, 7 - pos // 8 AS y, pos % 8 AS x, CASE c WHEN 0 THEN b ELSE 255 - b END AS v
           FROM (SELECT vec_id, pos, floor((x::DOUBLE + 1) * 127.5) AS b FROM bytes), (SELECT unnest([0, 1]) AS c)),
across AS (SELECT p.vec_id, p.c, p.y, o - 16 AS ox, round_even(w0 * p.v + w1 * q.v, 0) AS v
           FROM weights JOIN pixels p ON p.x = i0 JOIN pixels q ON q.x = i1 AND q.vec_id = p.vec_id AND q.c = p.c AND q.y = p.y),
final AS (SELECT p.vec_id, p.c, (o - 16) * 224 + p.ox AS pos, round_even(w0 * p.v + w1 * q.v, 0) AS v
          FROM weights JOIN across p ON p.y = i0 JOIN across q ON q.y = i1 AND q.vec_id = p.vec_id AND q.c = p.c AND q.ox = p.ox),
sums AS (SELECT vec_id, c, CAST(sum(v * (1 + pos % 9973)) AS BIGINT) AS total, min(v) AS low, max(v) AS high FROM final GROUP BY vec_id, c),
channels AS (SELECT vec_id, total, low, high, c, unnest([0.485, 0.456, 0.406]) AS mean, unnest([0.229, 0.224, 0.225]) AS std, unnest([0, 1, 0]) AS wanted FROM sums)
"""


@query(
    f"""WITH {RESAMPLED}
SELECT 'img_' || vec_id || '.bmp' AS filename, 150528 AS "values", max(total) FILTER (c = 0) AS red, max(total) FILTER (c = 1) AS green, max(total) FILTER (c = 0) AS blue,
       round(min((low / 255 - mean) / std)::FLOAT::DOUBLE, 4) AS lowest, round(max((high / 255 - mean) / std)::FLOAT::DOUBLE, 4) AS highest
FROM channels WHERE c = wanted GROUP BY vec_id"""
)
def image_tensors(spark, sf_dir):
    """Every pixel of the prepared images, by a checksum of each channel's values before they are standardised."""
    path = scratch_path(spark, "images")
    A.write_artifact_files(_bitmaps(spark, sf_dir), path)
    sums = I.image_tensors(A.read_images(spark, path).where("ok"), then=I.checksum_batches, schema=I.CHECKSUM_SCHEMA)
    return sums.select(
        F.regexp_extract("origin", r"([^/]+)$", 1).alias("filename"), F.lit(3 * I.CROP_TO**2).alias("values"), "red", "green", "blue",
        F.round(F.col("lowest").cast("double"), 4).alias("lowest"), F.round(F.col("highest").cast("double"), 4).alias("highest"),
    )
