"""The registered queries: each takes (spark, folder of tables) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import calibration_bin, decision, risk_band, snake_case
from ..operators import bands, drift, ensembles, features, metrics, models, permutation, quantiles, sampling, schema, slices
from ..operators.governance import promotion_checks as check_promotion
from ..sources import channels, digests, registry, tables
from ..storage import materialize, pin, scratch_path, small_table
from . import batch, report, training
from .views import docs_labeled, item_scores, orders_scored, orders_with_gaps, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NUMERIC = ["o_totalprice", "c_acctbal", "n_items", "qty"]
CATEGORICAL = ["o_orderpriority", "c_mktsegment", "o_orderstatus"]
MODELS = ["scorecard", "rival"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _rounded(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _two_scorecards(spark: SparkSession, folder: str) -> DataFrame:
    scores = item_scores(spark, folder).select(
        "label", F.col("p").alias(MODELS[0]), F.col("p_rival").alias(MODELS[1])
    )
    return scores.unpivot(["label"], MODELS, "model", "p")


def _scorecard_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.classification_metrics(_two_scorecards(spark, folder), ["model"])


# Report tables

@query
def scored_summary(spark, folder):
    return bands.scored_summary(item_scores(spark, folder))


@query
def risk_bands(spark, folder):
    return bands.risk_bands(item_scores(spark, folder))


@query
def calibration_bins(spark, folder):
    return bands.calibration_bins(item_scores(spark, folder))


@query
def report_payload(spark, folder):
    """Scored rows and metrics go through Parquet and JSON, the document through JSON."""
    base = scratch_path(spark, "report")
    scored = item_scores(spark, folder).select(
        F.col("label").alias("actual_default"), F.col("p").alias("default_probability"),
        decision("p").alias("predicted_default"),
    )
    tables.write_scored(scored, f"{base}/predictions")
    found = pin(_scorecard_metrics(spark, folder))
    tables.write_json(report.metrics_document(found, MODELS).coalesce(1), f"{base}/metrics")
    payload = report.write_report(spark, f"{base}/predictions", f"{base}/metrics", f"{base}/payload")
    return report.payload_rows(tables.read_json(spark, f"{base}/payload", payload.schema))


@query
def scored_rows(spark, folder):
    """Every scored row with its decision, band and calibration bin."""
    return item_scores(spark, folder).select(
        "row_id", F.col("label").alias("actual_default"), F.col("p").alias("default_probability"),
        decision("p").alias("predicted_default"), risk_band("p").alias("risk_band"),
        calibration_bin("p").alias("calibration_bin"),
    )


# Metrics

@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(item_scores(spark, folder))


@query
def threshold_metrics(spark, folder):
    return metrics.threshold_metrics(item_scores(spark, folder))


@query
def roc_auc_by_segment(spark, folder):
    by = ["o_orderpriority"]
    return metrics.ranking_metrics(orders_scored(spark, folder), by).select(*by, "rows", "roc_auc")


@query
def pr_auc_by_segment(spark, folder):
    by = ["c_mktsegment"]
    return metrics.ranking_metrics(orders_scored(spark, folder), by).select(*by, "rows", "pr_auc")


@query
def model_metrics(spark, folder):
    cell = F.col("confusion_matrix")
    return _scorecard_metrics(spark, folder).select(
        "*", cell[0][0].alias("tn"), cell[0][1].alias("fp"), cell[1][0].alias("fn"), cell[1][1].alias("tp")
    ).drop("confusion_matrix")


@query
def model_selection(spark, folder):
    return metrics.select_model(_scorecard_metrics(spark, folder), MODELS)


@query
def promotion_checks(spark, folder):
    return check_promotion(_scorecard_metrics(spark, folder), *MODELS)


@query
def slice_performance(spark, folder):
    return slices.slice_performance(orders_scored(spark, folder), CATEGORICAL)


@query
def document_slices(spark, folder):
    return slices.slice_performance(docs_labeled(spark, folder), ["lang", "source", "toxic"])


# Drift

DRIFTING = [*NUMERIC, "p"]
IS_REFERENCE = "sample = 'reference'"


def _order_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Read three times, so the joins run once."""
    return materialize(orders_scored(spark, folder).select("sample", *DRIFTING))


@query
def psi_edges(spark, folder):
    found = quantiles.column_quantiles(_order_samples(spark, folder), DRIFTING, config.PSI_BINS, IS_REFERENCE)
    edges = [(c, k, e) for c, q in found.items() for k, e in enumerate(q.edges)]
    feature, position, edge = map(list, zip(*edges))
    table_of_edges = small_table(spark, feature=feature, position=position, edge=edge)
    return _rounded(table_of_edges.withColumn("position", F.col("position").cast("int")), ["edge"])


@query
def psi_feature_drift(spark, folder):
    found = drift.stability_index(_order_samples(spark, folder), DRIFTING, IS_REFERENCE)
    return found.select("feature", "psi", "status")


@query
def psi_prediction_drift(spark, folder):
    scored = materialize(orders_scored(spark, folder).select("sample", "p"))
    reference = scored.filter(F.col("sample") == "reference")
    current = scored.filter(F.col("sample") == "current")
    return drift.prediction_drift(reference, current)


@query
def psi_constant_reference(spark, folder):
    """One constant reference that moved, one that did not, and one with two values only."""
    df = orders_scored(spark, folder).select(
        (F.col("sample") == "reference").alias("is_reference"),
        (F.col("sample") == "reference").cast("double").alias("moved"),
        F.signum("o_totalprice").alias("unmoved"),
        F.col("label").cast("double").alias("two_values"),
    )
    found = drift.stability_index(materialize(df), ["moved", "unmoved", "two_values"])
    return found.select("feature", "psi", "status")


# Splits and channels. A split reads its table three times, so the table is computed once.

def _labels(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return materialize(item_scores(spark, folder).select("row_id", "label", *columns))


@query
def stratified_split(spark, folder):
    return sampling.stratified_split(_labels(spark, folder))


@query
def three_way_split_manifest(spark, folder):
    split = channels.channel_split(_labels(spark, folder))
    return split.groupBy(F.col("split").alias("channel")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("label"), 6).alias("default_rate"),
        F.sum("row_id").alias("id_sum"),
    )


@query
def channel_roundtrip(spark, folder):
    """Write the four channels, read them back, and add them up."""
    base = scratch_path(spark, "channels")
    names, ddl = ["n_items", "qty"], "n_items bigint, qty double"
    channels.write_channels(channels.channel_split(_labels(spark, folder, *names)), base, names)
    parts = [
        channels.labeled_channel(spark, base, name, ddl).withColumn("channel", F.lit(name))
        for name in channels.LABELED
    ]
    held_out = channels.held_out_channel(spark, base, ddl).join(channels.test_labels(spark, base), "row_id")
    parts.append(held_out.withColumn("channel", F.lit(channels.HELD_OUT)))
    columns = ["channel", "label", *names]
    together = parts[0].select(columns).union(parts[1].select(columns)).union(parts[2].select(columns))
    return together.groupBy("channel").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"),
        F.sum("n_items").alias("n_items"), F.round(F.sum("qty"), 6).alias("qty"),
    )


@query
def channel_manifest(spark, folder):
    """Written channels by their manifest. Line order differs per run, so digests are held against the files' texts."""
    base = scratch_path(spark, "manifest")
    names = ["n_items", "qty"]
    split = channels.channel_split(_labels(spark, folder, *names))
    channels.write_channels(split, base, names)
    texts = spark.read.option("recursiveFileLookup", True).text(base, wholetext=True)
    again = texts.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), F.sha2("value", 256).alias("again"))
    listed = channels.manifest(spark, split, base, names).withColumn("name", F.element_at(F.split("file", "/"), -1))
    checked = listed.join(again, "name", "left").withColumn("same", F.coalesce(F.col("sha256") == F.col("again"), F.lit(False)))
    return checked.groupBy("channel", "rows", "default_rate", "feature_count").agg(
        F.array_join(F.max("feature_columns"), ",").alias("feature_columns"),
        F.bool_and("same").alias("digests_match"),
    )


@query
def batch_score_evaluation(spark, folder):
    base = scratch_path(spark, "batch")
    scored = item_scores(spark, folder)
    tables.write_csv(scored.select("row_id", "label"), f"{base}/labels", header=False)
    tables.write_csv(scored.select("row_id", "p"), f"{base}/scores", header=False)
    return batch.evaluate_scores(
        channels.read_headerless(spark, f"{base}/labels", "row_id bigint, label int"),
        channels.read_headerless(spark, f"{base}/scores", "row_id bigint, p double"),
    )


@query
def positional_bind(spark, folder):
    """Scores and labels written without a key line up by their line number."""
    base = scratch_path(spark, "lines")
    scored = materialize(item_scores(spark, folder).select("label", "p"))
    tables.write_csv(scored.select("label"), f"{base}/labels", header=False)
    tables.write_csv(scored.select("p"), f"{base}/scores", header=False)
    labels = tables.with_position(channels.read_headerless(spark, f"{base}/labels", "label int"))
    scores = tables.with_position(channels.read_headerless(spark, f"{base}/scores", "p double"))
    return batch.evaluate_scores(labels, scores)


# Schema and validation

@query
def normalize_columns(spark, folder):
    """Orders under untidy headers, two of them generic names."""
    untidy = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias(" Row ID"), F.col("o_custkey").alias("X1"),
        F.col("o_totalprice").alias("x12"), F.col("o_orderstatus").alias("Order--Status "),
        snake_case("o_orderpriority").alias("_Order.Priority_"),
        (F.col("o_orderstatus") == "F").cast("int").alias("default payment next month"),
    )
    return schema.normalize_columns(untidy)


def _raw_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    scores = item_scores(spark, folder)
    return (
        scores.select("row_id", F.col("row_id").alias("ID"), F.col("qty").alias("X1"), F.col("n_items").alias(" Age")),
        scores.select("row_id", F.col("label").alias("Y")),
    )


@query
def dataset_ingest(spark, folder):
    """Two raw tables under generic names are bound, validated, kept as CSV and read back."""
    return tables.ingest_dataset(*_raw_tables(spark, folder), scratch_path(spark, "ingest"))


@query
def dataset_load(spark, folder):
    """A headed CSV under generic names, read with types by name."""
    path = scratch_path(spark, "raw")
    raw, target = _raw_tables(spark, folder)
    tables.write_csv(raw.drop("ID").join(target, "row_id"), path)
    ddl = f"row_id bigint, limit_bal double, age int, {config.TARGET} int"
    return tables.load_dataset(spark, path, schema=ddl)


def _uneven_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with what CSV easily loses: outer blanks, quotes, backslashes, line breaks, empty texts and nulls."""
    return table(spark, folder, "documents").select(
        "doc_id", "lang",
        F.expr(
            "case doc_id % 8 when 0 then concat(' ', text, ' ') when 1 then concat('\"', text, '\"') when 2 then concat(text, chr(92))"
            " when 3 then concat(text, chr(13), chr(10), 'x') when 4 then '' when 5 then null when 6 then concat(chr(92), '\"', text) else text end"
        ).alias("text"),
    )


@query
def text_roundtrip(spark, folder):
    """Texts written as CSV and read back."""
    path = scratch_path(spark, "texts")
    uneven = _uneven_texts(spark, folder)
    tables.write_csv(uneven, path, rows_per_file=10_000)
    kept = tables.read_csv(spark, path, uneven.schema)
    return kept.select("doc_id", "lang", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("sha256"))


@query
def dataset_load_rejects(spark, folder):
    """Lines of orders, some with a field too many and some with a text for a number: good rows, and the rest with reasons."""
    path = scratch_path(spark, "lines")
    line = (
        "concat_ws(',', cast(o_orderkey as string), if(o_orderkey % 11 = 0, 'n/a', cast(o_custkey as string)),"
        " concat('\"', o_orderpriority, ', ', o_orderstatus, '\"'), cast(int(o_orderstatus = 'F') as string), if(o_orderkey % 7 = 0, 'more', null))"
    )
    table(spark, folder, "orders").select(F.expr(line).alias("value")).write.text(path)
    ddl = f"row_id bigint, limit_bal int, name string, {config.TARGET} int"
    good, rejects = tables.load_with_rejects(spark, path, ddl, header=False)
    return good.unionByName(rejects.drop("file"), allowMissingColumns=True)


@query
def validation_report(spark, folder):
    return schema.validation_report(orders_with_gaps(spark, folder), "n_returned")


@query
def validation_report_text_target(spark, folder):
    return schema.validation_report(orders_with_gaps(spark, folder), "size")


@query
def feature_target_bind(spark, folder):
    """All orders keep their row; those without items get a null target."""
    order_features = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("row_id"), "o_totalprice", "o_orderpriority"
    )
    return schema.bind_features_target(order_features, item_scores(spark, folder).select("row_id", "label"))


# Feature preparation

@query
def median_mode_impute(spark, folder):
    df = materialize(orders_with_gaps(spark, folder).select("row_id", "n_items", "qty", "size", "o_orderpriority"))
    return features.impute(df, features.fit_fill_values(df, ["n_items", "qty"], ["size", "o_orderpriority"]))


@query
def standardize(spark, folder):
    df = materialize(orders_scored(spark, folder).select("row_id", *NUMERIC))
    return _rounded(features.standardize(df, features.fit_scale(df, NUMERIC)), NUMERIC)


@query
def one_hot(spark, folder):
    """Categories come from orders of three items up, so ``small`` and missing are unknown."""
    df = materialize(orders_with_gaps(spark, folder).select("row_id", "o_orderstatus", "size", "n_items"))
    known = quantiles.text_counts(df.filter("n_items >= 3"), ["o_orderstatus", "size"])
    return features.one_hot(df.drop("n_items"), features.fit_categories(known))


@query
def prepared_features(spark, folder):
    """The vector the models see: scaled numbers, then one position per category."""
    df = materialize(orders_scored(spark, folder).select("row_id", *NUMERIC, *CATEGORICAL))
    prepared = features.fit_preparation(df, NUMERIC, CATEGORICAL).fit(df).transform(df)
    values = vector_to_array("features")
    return prepared.select("row_id", F.transform(values, lambda v: F.round(v, 6)).alias("v")).select(
        "row_id", *[F.col("v")[i].alias(f"v{i}") for i in range(17)]
    )


# Importance

@query
def seeded_donors(spark, folder):
    """Each row's donor in two seeded shuffles."""
    donors = sampling.seeded_donors(_labels(spark, folder, "n_items", "qty"), ["n_items", "qty"])
    return donors.select("row_id", "repeat", "donor.n_items", "donor.qty")


@query
def permutation_importance_scorecard(spark, folder):
    """Closed-form score; ``qty`` does not enter it, so its importance is zero."""
    def score(df: DataFrame) -> DataFrame:
        raw = F.lit(0.7) - F.lit(0.12) * F.col("n_items") + F.lit(0.009) * F.col("dc") / F.col("n_items")
        return df.withColumn("p", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)), 6))

    importance = permutation.permutation_importance(
        item_scores(spark, folder), score, ["n_items", "dc", "qty"]
    )
    return permutation.top_features(importance)


# Models and whole flows. What fitted models return depends on summation order, so all but train_logistic, whose
# slopes vanish at the solution, have no SQL; tests hold them against brute force.

def _model_table(spark: SparkSession, folder: str) -> DataFrame:
    """Training reads it many times, so the joins run once."""
    return materialize(orders_scored(spark, folder).select("row_id", "label", *NUMERIC, *CATEGORICAL))


def _fit_and_test(spark: SparkSession, folder: str, name: str):
    split = materialize(sampling.stratified_split(_model_table(spark, folder)), partition_by="split")
    train, test = (split.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    return models.fit_models(train, NUMERIC, CATEGORICAL, names=[name])[name], train, test


@query
def train_logistic(spark, folder):
    """The slope of the penalised loss at the solution, per coefficient, and the classes of both parts."""
    model, train, test = _fit_and_test(spark, folder, config.BASELINE_MODEL)
    weighted, rows = models.balanced_weights(train)
    slopes = models.penalised_gradient(model, weighted, rows)
    part = train.select("label", F.lit("train").alias("part")).union(test.select("label", F.lit("test").alias("part")))
    counts = [F.count_if((F.col("part") == p) & (F.col("label") == y)).alias(f"{p}_{y}") for p in ("train", "test") for y in (0, 1)]
    return slopes.select("term", F.abs(F.round("gradient", 4)).alias("gradient")).join(F.broadcast(part.agg(*counts)))  # one row


def _with_trees(found: DataFrame, fitted: dict) -> DataFrame:
    trees = F.create_map(*[x for name, m in fitted.items() for x in (F.lit(name), F.lit(models.tree_count(m)))])
    return found.withColumn("trees", trees[F.col("model")])


@query
def train_boosting(spark, folder):
    """All metrics of the challenger on the test part, and its number of trees."""
    model, _, test = _fit_and_test(spark, folder, config.CHALLENGER_MODEL)
    fitted = {config.CHALLENGER_MODEL: model}
    return _with_trees(training.compare_models(fitted, test, "label"), fitted)


@query
def boosting_first_round(spark, folder):
    """The leaves of the challenger's first tree against the training rows that come to them."""
    split = materialize(sampling.stratified_split(_model_table(spark, folder)), partition_by="split")
    train = split.filter(F.col("split") == "train").drop("split")
    fitted = models.fit_models(train, NUMERIC, CATEGORICAL, names=[config.CHALLENGER_MODEL], rounds=1)[config.CHALLENGER_MODEL]
    path = scratch_path(spark, "first-round")
    PipelineModel(stages=fitted.stages[-1:]).save(path)
    leaves = ensembles.leaf_table(fitted.stages[0].transform(train), ensembles.ensemble_nodes(spark, path))
    return leaves.agg(
        F.sum("rows").alias("train_rows"), F.sum("seen").alias("rows_met"),
        F.round(F.sum(F.col("prediction") * F.col("rows")) / F.sum("rows"), 6).alias("mean_sign"),
        F.round(F.max(F.abs(F.col("prediction") - F.col("mean"))), 9).alias("largest_gap"), (F.count(F.lit(1)) > 1).alias("splits"),
    )


@query
def permutation_importance_model(spark, folder):
    """The importance of every feature for the baseline."""
    model, _, test = _fit_and_test(spark, folder, config.BASELINE_MODEL)
    return permutation.top_features(permutation.linear_importance(model, test, NUMERIC, CATEGORICAL))


@query
def train_and_evaluate(spark, folder):
    """All metrics of both models on the test part, and which one the flow selects."""
    found = training.train_and_evaluate(
        _model_table(spark, folder), scratch_path(spark, "train"), numeric=NUMERIC, categorical=CATEGORICAL,
        label="label", monitored=NUMERIC, slices=CATEGORICAL,
    )
    return _with_trees(found.metrics, found.models).withColumn("selected", F.col("model") == found.selected_model)


@query
def batch_flow(spark, folder):
    """Rows, ROC-AUC and average precision of the held-out channel, the trees of the model that scored it, and how
    far its scores are from those of its table of nodes."""
    base = scratch_path(spark, "batch-flow")
    df = _model_table(spark, folder)
    found = batch.batch_flow(df, base, numeric=NUMERIC, categorical=CATEGORICAL)
    model = PipelineModel.load(f"{base}/model")
    gap = batch.largest_gap(spark, base, ", ".join(f"{c} {t}" for c, t in df.select(*NUMERIC, *CATEGORICAL).dtypes))
    return found.select("*", F.lit(models.tree_count(model)).alias("trees"), F.lit(round(gap, 9)).alias("largest_gap"))


# Monitoring and table parts

@query
def monitoring_bundle(spark, folder):
    """Drift of scores and features, slices of the current sample and the thresholds, as one JSON document read back."""
    scored = materialize(orders_scored(spark, folder).select("sample", "label", *DRIFTING, *CATEGORICAL))
    reference, current = (scored.filter(F.col("sample") == s) for s in ("reference", "current"))
    parts = drift.prediction_drift(reference, current), drift.feature_drift(reference, current, NUMERIC), slices.slice_performance(current, CATEGORICAL)
    path = scratch_path(spark, "monitoring")
    tables.write_json(report.monitoring_document(*map(pin, parts)).coalesce(1), path)
    return report.monitoring_rows(tables.read_json(spark, path, report.MONITORING_SCHEMA))


@query
def features_and_target(spark, folder):
    """Both projections of one table, joined again on the key they keep."""
    scored = item_scores(spark, folder).select("row_id", "n_items", "qty", F.col("label").alias(config.TARGET))
    inputs, target = schema.split_features_target(scored)
    return inputs.join(target, "row_id")


@query
def column_partition(spark, folder):
    """Which orders columns count as numbers and which as categories, with their distinct values."""
    orders = table(spark, folder, "orders").select("o_totalprice", "o_orderstatus", "o_custkey", "o_orderpriority")
    numeric, categorical = schema.partition_columns(orders.columns, ["o_orderpriority", "o_orderstatus"])
    kinds = [*[(c, "numeric") for c in numeric], *[(c, "categorical") for c in categorical]]
    counts = orders.agg(*[F.count_distinct(c).alias(c) for c, _ in kinds])
    rows = [F.struct(F.lit(c).alias("name"), F.lit(k).alias("kind"), F.lit(i).alias("place"), F.col(c).alias("values")) for i, (c, k) in enumerate(kinds)]
    return counts.select(F.inline(F.array(*rows)))


@query
def code_impute(spark, folder):
    """Category codes held as floating-point numbers: NaN is filled with the mode like null."""
    gaps = orders_with_gaps(spark, folder).select("row_id", F.coalesce(F.col("n_items").cast("double"), F.lit(float("nan"))).alias("code"))
    df = materialize(gaps)
    return features.impute(df, features.fit_fill_values(df, [], ["code"]))


# Registry

_KEYS_PER_FILE = 50_000


def _write_lines(spark: SparkSession, folder: str, path: str) -> None:
    """Orders as sorted text lines, one file for each range of keys: bytes that SQL can tell."""
    lines = table(spark, folder, "orders").select(
        F.expr(f"o_orderkey div {_KEYS_PER_FILE}").alias("part"), "o_orderkey",
        F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("value"),
    )
    dealt = lines.repartition("part").sortWithinPartitions("part", "o_orderkey").drop("o_orderkey")
    dealt.write.partitionBy("part").option("lineSep", "\n").text(path)


@query
def model_registry(spark, folder):
    """Register both scorecards; the registry is read back without its times."""
    base = scratch_path(spark, "registry")
    _write_lines(spark, folder, f"{base}/artifact")
    found = pin(_scorecard_metrics(spark, folder))
    for name in MODELS:
        registry.append(registry.registry_entry(found, name, f"{base}/artifact"), f"{base}/models")
    entries = spark.read.parquet(f"{base}/models")
    return entries.select(
        "stage", "model", "selection_metric", F.col("metrics.pr_auc").alias("pr_auc"),
        "artifact_sha256", F.length("version").alias("version_length"),
    )


@query
def run_log(spark, folder):
    base = scratch_path(spark, "runs")
    found = pin(_scorecard_metrics(spark, folder))
    for name in MODELS:
        registry.append(registry.run_log(found, name), base)
    return spark.read.parquet(base)


@query
def document_digest(spark, folder):
    """SHA-256 of every whole text."""
    return table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query
def corpus_digest(spark, folder):
    """The digests of all texts, folded in two levels like those of an artifact's files."""
    return digests.fold_digests(document_digest(spark, folder))


@query
def artifact_digest(spark, folder):
    """Digest of an artifact of several files whose bytes are known."""
    path = scratch_path(spark, "lines")
    _write_lines(spark, folder, path)
    return digests.artifact_digest(spark, path)
