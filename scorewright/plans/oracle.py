"""SQL with the same results as the registered queries, for an independent engine."""

from __future__ import annotations

from .. import config

ITEMS = """items AS (
  SELECT l_orderkey AS row_id, count(*) AS n_items, sum(l_quantity) AS qty,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
         CAST(sum(CAST(round(l_discount * 100) AS INTEGER)) AS BIGINT) AS dc
  FROM lineitem GROUP BY l_orderkey)"""


def _score(base: str, per_item: str, n_items: str = "n_items", dc: str = "dc") -> str:
    return (
        f"round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, {base}::DOUBLE - {per_item}::DOUBLE * {n_items}"
        f" + 0.009::DOUBLE * {dc} / {n_items})), 6)"
    )


SCORED = f"""{ITEMS}, scored AS (
  SELECT *, CAST(2 * n_returned > n_items AS INTEGER) AS label,
         {_score('0.7', '0.12')} AS p, {_score('0.45', '0.05')} AS p_rival
  FROM items)"""

ORDERS = f"""{SCORED}, orders_scored AS (
  SELECT s.row_id, label, p, n_items, qty, o_totalprice, o_orderpriority, o_orderstatus,
         c_acctbal, c_mktsegment,
         CASE WHEN year(o_orderdate) < 1998 THEN 'reference' ELSE 'current' END AS sample
  FROM orders JOIN scored s ON o_orderkey = s.row_id JOIN customer ON o_custkey = c_custkey)"""

GAPS = f"""{ITEMS}, gaps AS (
  SELECT o_orderkey AS row_id, o_totalprice, o_orderstatus, o_orderpriority, n_items, qty, n_returned,
         CASE WHEN n_items >= 6 THEN 'large' WHEN n_items >= 3 THEN 'medium'
              WHEN n_items IS NOT NULL THEN 'small' END AS size
  FROM orders LEFT JOIN items ON o_orderkey = row_id)"""

CARDS = f"""{SCORED}, cards AS (
  SELECT 'scorecard' AS model, label, p FROM scored
  UNION ALL SELECT 'rival', label, p_rival FROM scored)"""

RATES = """count(*) AS clients, round(avg(label), 6) AS observed_default_rate,
       round(avg(p), 6) AS average_probability"""


def _ranking(source: str, by: str) -> str:
    """CTEs ``pr`` (average precision) and ``auc`` (mean-rank statistic) per ``by``."""
    return f"""steps AS (
  SELECT {by}, p, count(*) AS n, sum(label) AS pos FROM {source} GROUP BY {by}, p),
cumulated AS (
  SELECT *, sum(n) OVER w AS n_upto, sum(pos) OVER w AS pos_upto FROM steps
  WINDOW w AS (PARTITION BY {by} ORDER BY p DESC)),
pr AS (
  SELECT {by}, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(pos) AS BIGINT) AS n_pos,
         coalesce(sum(pos * (pos_upto / n_upto)) / nullif(sum(pos), 0), 0) AS pr_auc
  FROM cumulated GROUP BY {by}),
ranked AS (
  SELECT {by}, label, rank() OVER (PARTITION BY {by} ORDER BY p)
         + (count(*) OVER (PARTITION BY {by}, p) - 1) / 2 AS r FROM {source}),
auc AS (
  SELECT {by}, (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2)
         / nullif(sum(label) * (count(*) - sum(label)), 0) AS roc_auc
  FROM ranked GROUP BY {by})"""


CELLS = """count(*) FILTER (WHERE p < 0.5 AND label = 0) AS tn,
  count(*) FILTER (WHERE p >= 0.5 AND label = 0) AS fp,
  count(*) FILTER (WHERE p < 0.5 AND label = 1) AS fn,
  count(*) FILTER (WHERE p >= 0.5 AND label = 1) AS tp,
  avg((p - label) * (p - label)) AS brier"""

THRESHOLD = """round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
  round(brier, 6) AS brier_score"""

MODEL_METRICS = f"""{CARDS}, {_ranking('cards', 'model')},
cells AS (SELECT model, {CELLS} FROM cards GROUP BY model),
model_metrics AS (
  SELECT model, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, {THRESHOLD}, tn, fp, fn, tp
  FROM pr JOIN auc USING (model) JOIN cells USING (model))"""


def _slices(source: str, columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS slice_column, coalesce(CAST({c} AS VARCHAR), 'nan') AS value, label, p FROM {source}"
        for c in columns
    )
    return f"""long AS ({parts}), {_ranking('long', 'slice_column, value')}
SELECT l.slice_column, l.value, count(*) AS rows, round(avg(label), 6) AS observed_default_rate,
       round(avg(p), 6) AS predicted_default_rate,
       CASE WHEN min(label) <> max(label) THEN round(max(pr_auc), 6) END AS pr_auc
FROM long l JOIN pr ON pr.slice_column = l.slice_column AND pr.value = l.value
GROUP BY l.slice_column, l.value"""


def _quantile_list() -> str:
    step = 1.0 / config.PSI_BINS
    grid = [k * step for k in range(config.PSI_BINS)] + [1.0]
    return "[" + ", ".join(repr(q) for q in grid) + "]::DOUBLE[]"


def _psi(long: str) -> str:
    """``long`` has feature, is_ref, v. CTEs up to ``psi``."""
    return f"""edges AS (
  SELECT feature, quantile_cont(v, {_quantile_list()}) AS grid FROM {long} WHERE is_ref GROUP BY feature),
distinct_edges AS (SELECT feature, grid, list_sort(list_distinct(grid)) AS e FROM edges),
binned AS (
  SELECT feature, is_ref, v, e, len(list_filter(e[2:-2], lambda x: x <= v)) AS bin
  FROM {long} JOIN distinct_edges USING (feature)),
sizes AS (
  SELECT feature, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur,
         avg(v) FILTER (WHERE is_ref) AS ref_mean, avg(v) FILTER (WHERE NOT is_ref) AS cur_mean,
         any_value(len(e)) AS n_edges,
         bool_and(is_ref OR abs(e[1] - v) <= 1e-8 + 1e-5 * abs(v)) AS close
  FROM binned GROUP BY feature),
shares AS (
  SELECT feature, bin, count(*) FILTER (WHERE is_ref) / any_value(n_ref) AS r,
         count(*) FILTER (WHERE NOT is_ref) / any_value(n_cur) AS c
  FROM binned JOIN sizes USING (feature) GROUP BY feature, bin),
psi AS (
  SELECT feature, any_value(ref_mean) AS ref_mean, any_value(cur_mean) AS cur_mean,
         CASE WHEN any_value(n_edges) < 2 THEN CASE WHEN bool_and(close) THEN 0.0 ELSE 1.0 END
              ELSE round(sum((c - r) * ln((c + 1e-6) / (r + 1e-6))), 6) END::DOUBLE AS psi
  FROM shares JOIN sizes USING (feature) GROUP BY feature)"""


STATUS = "CASE WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.10 THEN 'watch' ELSE 'stable' END AS status"


def _long(source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, sample = 'reference' AS is_ref, CAST({e} AS DOUBLE) AS v FROM {source}"
        for name, e in columns.items()
    )


NUMERIC = ("o_totalprice", "c_acctbal", "n_items", "qty")
CATEGORIES = [
    *(("o_orderpriority", v) for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
    *(("c_mktsegment", v) for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
    *(("o_orderstatus", v) for v in ("F", "O", "P")),
]
DRIFT_COLUMNS = {c: c for c in ("o_totalprice", "c_acctbal", "n_items", "qty", "p")}
CONSTANTS = {
    "moved": "sample = 'reference'", "unmoved": "sign(o_totalprice)", "two_values": "label",
}


def _split(first: float, nested: bool) -> str:
    """``split_rows``: the scored rows with their part. Largest-remainder class counts."""
    def allocate(name: str, source: str, total: str) -> str:
        return f"""{name}_base AS (
  SELECT label, cnt, {total} AS draws, floor(cnt * {total} / sum(cnt) OVER ()) AS base,
         cnt * {total} / sum(cnt) OVER () AS exact FROM {source}),
{name} AS (
  SELECT label, cnt, CAST(base + CASE WHEN row_number() OVER (ORDER BY base - exact, label)
         <= draws - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS take FROM {name}_base)"""

    classes = "classes AS (SELECT label, count(*) AS cnt FROM scored GROUP BY label)"
    train = allocate("train", "classes", f"(sum(cnt) OVER () - ceil({first}::DOUBLE * sum(cnt) OVER ()))")
    ranked = """ranked_rows AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || row_id), row_id) AS rn FROM scored)"""
    if not nested:
        return f"""{classes}, {train}, {ranked}, split_rows AS (
  SELECT r.*, CASE WHEN rn <= take THEN 'train' ELSE 'test' END AS split FROM ranked_rows r JOIN train USING (label))"""
    rest = "rest AS (SELECT label, cnt - take AS cnt FROM train)"
    second = allocate("validation", "rest", "(sum(cnt) OVER () - ceil(0.5::DOUBLE * sum(cnt) OVER ()))")
    return f"""{classes}, {train}, {rest}, {second}, {ranked}, split_rows AS (
  SELECT r.*, CASE WHEN rn <= t.take THEN 'train' WHEN rn <= t.take + v.take THEN 'validation'
         ELSE 'transform' END AS split
  FROM ranked_rows r JOIN train t USING (label) JOIN validation v USING (label))"""


_HASHED = """repeats AS (SELECT unnest([1, 2]) AS repeat), hashed AS (
  SELECT scored.*, repeat, md5('42:' || repeat || ':' || row_id) AS h FROM scored, repeats)"""


def _donors(columns: list[str]) -> str:
    """Donor rows by seeded cyclic order, for two repeats."""
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    taken = ", ".join(
        f"coalesce(lag({c}) OVER w, last_value({c}) OVER (w {whole})) AS d_{c}" for c in columns
    )
    return f"""{_HASHED}, donors AS (
  SELECT *, {taken} FROM hashed WINDOW w AS (PARTITION BY repeat ORDER BY h, row_id))"""


def _importance(columns: list[str], score: str) -> str:
    variants = " UNION ALL ".join(
        [f"SELECT 'none' AS feature, repeat, label, {', '.join(columns)} FROM donors WHERE repeat = 1"]
        + [
            f"SELECT '{c}', repeat, label, {', '.join(f'd_{x}' if x == c else x for x in columns)} FROM donors"
            for c in columns
        ]
    )
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(columns, 1))
    return f"""{_donors(columns)}, variants AS ({variants}),
rescored AS (SELECT feature, repeat, label, {score} AS p FROM variants),
{_ranking('rescored', 'feature, repeat')}
SELECT feature, round(avg((SELECT pr_auc FROM pr WHERE feature = 'none') - pr_auc), 6) AS importance,
       CASE feature {order} END AS position
FROM pr WHERE feature <> 'none' GROUP BY feature ORDER BY importance DESC, position LIMIT 10"""


def _validation(target: str) -> str:
    columns = ["row_id", "o_totalprice", "o_orderstatus", "o_orderpriority", "n_items", "qty", "n_returned", "size"]
    number = f"try_cast({target} AS DOUBLE)"
    return f"WITH {GAPS} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls, """
        + (
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND {number} IS NULL) AS bad_cast, "
            f"count(*) FILTER (WHERE {number} NOT IN (0, 1)) AS bad_domain"
            if c == target else "0::BIGINT AS bad_cast, 0::BIGINT AS bad_domain"
        )
        + " FROM gaps"
        for c in columns
    )


_BIN_LABELS = (
    "['(-0.001, 0.1]', '(0.1, 0.2]', '(0.2, 0.3]', '(0.3, 0.4]', '(0.4, 0.5]',"
    " '(0.5, 0.6]', '(0.6, 0.7]', '(0.7, 0.8]', '(0.8, 0.9]', '(0.9, 1.0]']"
)
_BIN = "1 + len(list_filter(range(1, 10), lambda k: p > k * 0.1::DOUBLE))"
BANDS = f"""banded AS (
  SELECT CASE WHEN p < 0.2 THEN 'low' WHEN p < 0.5 THEN 'review' ELSE 'high' END AS band, {RATES}
  FROM scored GROUP BY 1),
bands AS (
  SELECT band, coalesce(clients, 0) AS clients, coalesce(observed_default_rate, 0) AS observed_default_rate,
         coalesce(average_probability, 0) AS average_probability
  FROM (VALUES ('low'), ('review'), ('high')) b(band) LEFT JOIN banded USING (band))"""
CALIBRATION = f"""calibration AS (
  SELECT CAST(bin_index AS INTEGER) AS bin_index, clients, observed_default_rate, average_probability,
         ({_BIN_LABELS})[bin_index] AS bin
  FROM (SELECT {_BIN} AS bin_index, {RATES} FROM scored WHERE p BETWEEN 0 AND 1 GROUP BY 1))"""
SUMMARY = """summary AS (
  SELECT count(*) AS scored_rows, CAST(sum(label) AS BIGINT) AS observed_defaults,
         round(avg(label), 6) AS default_rate, round(avg(p), 6) AS average_probability FROM scored)"""
SELECTED = "(SELECT model FROM model_metrics ORDER BY pr_auc DESC, model = 'rival' LIMIT 1)"
SELECT_RANKING = "round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc"


def _unrolled(section: str, source: str, item: str, fields: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} AS item, '{f}' AS field, CAST({f} AS DOUBLE) AS value FROM {source}"
        for f in fields
    )


_RATE_FIELDS = ["clients", "observed_default_rate", "average_probability"]
_METRICS = ["roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score"]


def _checks() -> str:
    policy = config.PromotionPolicy()
    return f"""checks AS (
  SELECT r.pr_auc - s.pr_auc >= {policy.minimum_pr_auc_gain}::DOUBLE AS pr_auc_gain,
         r.brier_score - s.brier_score <= {policy.maximum_brier_degradation}::DOUBLE AS calibration,
         r.recall >= {policy.minimum_recall}::DOUBLE AS minimum_recall
  FROM model_metrics s JOIN model_metrics r ON s.model = 'scorecard' AND r.model = 'rival')
SELECT pr_auc_gain AND calibration AND minimum_recall AS promote, *,
       {policy.minimum_pr_auc_gain}::DOUBLE AS policy_minimum_pr_auc_gain,
       {policy.maximum_brier_degradation}::DOUBLE AS policy_maximum_brier_degradation,
       {policy.minimum_recall}::DOUBLE AS policy_minimum_recall,
       '{config.ROLLBACK_TRIGGER}' AS rollback_trigger
FROM checks"""


_DOCS = """docs AS (
  SELECT quality AS label, toxic, lang, source,
         round(n_chars::DOUBLE / (n_chars::DOUBLE + 1000.0::DOUBLE), 6) AS p
  FROM labels JOIN documents USING (doc_id))"""
_ONE_GROUP = "(SELECT *, 1 AS one FROM scored)"
_EVALUATION = (
    f"WITH {SCORED}, {_ranking(_ONE_GROUP, 'one')} "
    f"SELECT n_rows AS rows, {SELECT_RANKING} FROM pr JOIN auc USING (one)"
)

_FILES = """files AS (
  SELECT sha256(string_agg(o_orderkey || ',' || o_orderstatus || chr(10), '' ORDER BY o_orderkey)) AS d
  FROM orders GROUP BY o_orderkey // 50000)"""


def _folded(source: str) -> str:
    """``folded``: the digests ``d`` of a table as the root of the digest tree (depths up to 4)."""
    levels = "".join(
        f"""
level{k} AS (SELECT CASE WHEN {k} < depth THEN substr(prefix, 1, {2 * k}) ELSE prefix END AS prefix, max(depth) AS depth,
  CASE WHEN {k} < max(depth) THEN sha256(string_agg(entry, ',' ORDER BY prefix)) ELSE max(entry) END AS entry
  FROM level{k + 1} GROUP BY CASE WHEN {k} < depth THEN substr(prefix, 1, {2 * k}) ELSE prefix END),"""
        for k in range(3, -1, -1)
    )
    return f"""counted AS (SELECT d, count(*) AS n FROM {source} GROUP BY d),
sizes AS (SELECT CAST(greatest(0, ceil(log(greatest(count(*), 1) / 256.0) / log(256))) AS INTEGER) AS depth, sum(n) AS n FROM counted),
level4 AS (SELECT substr(d, 1, 2 * depth) AS prefix, max(depth) AS depth,
  sha256(string_agg(d || ':' || counted.n, ',' ORDER BY d)) AS entry FROM counted, sizes GROUP BY substr(d, 1, 2 * depth)),{levels}
folded AS (SELECT CASE WHEN (SELECT n FROM sizes) = 1 THEN (SELECT max(d) FROM counted) ELSE entry END AS sha256 FROM level0)"""


_MODEL_ROWS = f"WITH {ORDERS}, {_split(0.2, False).replace('FROM scored', 'FROM orders_scored')}"


ORACLE: dict[str, str] = {
    "scored_rows": f"""WITH {SCORED}
SELECT row_id, label AS actual_default, p AS default_probability, CAST(p >= 0.5 AS INTEGER) AS predicted_default,
       CASE WHEN p < 0.2 THEN 'low' WHEN p < 0.5 THEN 'review' ELSE 'high' END AS risk_band,
       CAST({_BIN} AS INTEGER) AS calibration_bin FROM scored""",
    "dataset_ingest": f"""WITH {SCORED}
SELECT row_id, qty AS limit_bal, n_items AS age, CAST(label AS TINYINT) AS default_next_month FROM scored""",
    "dataset_load": f"""WITH {SCORED}
SELECT row_id, qty AS limit_bal, CAST(n_items AS INTEGER) AS age, CAST(label AS TINYINT) AS default_next_month
FROM scored""",
    "seeded_donors": f"WITH {SCORED}, {_donors(['n_items', 'qty'])} "
    "SELECT row_id, repeat, d_n_items AS n_items, d_qty AS qty FROM donors",
    "document_digest": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "scored_summary": f"WITH {SCORED}, {SUMMARY} SELECT * FROM summary",
    "risk_bands": f"WITH {SCORED}, {BANDS} SELECT * FROM bands",
    "calibration_bins": f"WITH {SCORED}, {CALIBRATION} SELECT * FROM calibration",
    "report_payload": f"""WITH {MODEL_METRICS}, {BANDS}, {CALIBRATION}, {SUMMARY}
{_unrolled('summary', 'summary', SELECTED, ['scored_rows', 'observed_defaults', 'default_rate', 'average_probability'])}
UNION ALL {_unrolled('models', 'model_metrics', 'model', _METRICS)}
UNION ALL {_unrolled('risk_bands', 'bands', 'band', _RATE_FIELDS)}
UNION ALL {_unrolled('calibration', 'calibration', 'bin', _RATE_FIELDS)}""",
    "confusion_matrix": f"""WITH {SCORED}
SELECT a.v AS actual, d.v AS predicted, count(label) AS rows
FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) d(v)
LEFT JOIN scored ON label = a.v AND CAST(p >= 0.5 AS INTEGER) = d.v GROUP BY a.v, d.v""",
    "threshold_metrics": f"WITH {SCORED}, cells AS (SELECT {CELLS} FROM scored) SELECT {THRESHOLD} FROM cells",
    "roc_auc_by_segment": f"""WITH {ORDERS}, {_ranking('orders_scored', 'o_orderpriority')}
SELECT o_orderpriority, n_rows AS rows, round(roc_auc, 6) AS roc_auc FROM pr JOIN auc USING (o_orderpriority)""",
    "pr_auc_by_segment": f"""WITH {ORDERS}, {_ranking('orders_scored', 'c_mktsegment')}
SELECT c_mktsegment, n_rows AS rows, round(pr_auc, 6) AS pr_auc FROM pr""",
    "model_metrics": f"WITH {MODEL_METRICS} SELECT * FROM model_metrics",
    "model_selection": f"""WITH {MODEL_METRICS}
SELECT model AS selected_model, pr_auc, 'pr_auc' AS selection_metric
FROM model_metrics ORDER BY pr_auc DESC, model = 'rival' LIMIT 1""",
    "promotion_checks": f"WITH {MODEL_METRICS}, {_checks()}",
    "slice_performance": f"WITH {ORDERS}, "
    + _slices("orders_scored", ["o_orderpriority", "c_mktsegment", "o_orderstatus"]),
    "document_slices": f"WITH {_DOCS}, " + _slices("docs", ["lang", "source", "toxic"]),
    "psi_edges": f"""WITH {ORDERS}, long AS ({_long('orders_scored', DRIFT_COLUMNS)}), {_psi('long')}
SELECT feature, CAST(k AS INTEGER) AS position, round(grid[k + 1], 6) AS edge FROM edges, range(0, 11) t(k)""",
    "psi_feature_drift": f"""WITH {ORDERS}, long AS ({_long('orders_scored', DRIFT_COLUMNS)}), {_psi('long')}
SELECT feature, psi, {STATUS} FROM psi""",
    "psi_prediction_drift": f"""WITH {ORDERS}, long AS ({_long('orders_scored', {'p': 'p'})}), {_psi('long')}
SELECT psi, round(ref_mean, 6) AS reference_mean, round(cur_mean, 6) AS current_mean, {STATUS} FROM psi""",
    "psi_constant_reference": f"""WITH {ORDERS}, long AS ({_long('orders_scored', CONSTANTS)}), {_psi('long')}
SELECT feature, psi, {STATUS} FROM psi""",
    "stratified_split": f"WITH {SCORED}, {_split(0.2, False)} SELECT row_id, label, split FROM split_rows",
    "three_way_split_manifest": f"""WITH {SCORED}, {_split(0.3, True)}
SELECT split AS channel, count(*) AS rows, round(avg(label), 6) AS default_rate,
       CAST(sum(row_id) AS BIGINT) AS id_sum FROM split_rows GROUP BY split""",
    "channel_roundtrip": f"""WITH {SCORED}, {_split(0.3, True)}
SELECT split AS channel, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives,
       CAST(sum(n_items) AS BIGINT) AS n_items, round(sum(qty), 6) AS qty FROM split_rows GROUP BY split""",
    "channel_manifest": f"""WITH {SCORED}, {_split(0.3, True)}, parts AS (
  SELECT split AS channel, label FROM split_rows
  UNION ALL SELECT 'test_labels', label FROM split_rows WHERE split = 'transform')
SELECT channel, count(*) AS rows, round(avg(label), 6) AS default_rate, 2 AS feature_count,
       'n_items,qty' AS feature_columns, true AS digests_match FROM parts GROUP BY channel""",
    "batch_score_evaluation": _EVALUATION,
    "positional_bind": _EVALUATION,
    "normalize_columns": """SELECT o_orderkey AS row_id, o_custkey AS limit_bal, o_totalprice AS bill_amt1,
  o_orderstatus AS order_status,
  trim(lower(regexp_replace(o_orderpriority, '[^a-zA-Z0-9]+', '_', 'g')), '_') AS order_priority,
  CAST(o_orderstatus = 'F' AS INTEGER) AS default_next_month FROM orders""",
    "validation_report": _validation("n_returned"),
    "validation_report_text_target": _validation("size"),
    "feature_target_bind": f"""WITH {SCORED}
SELECT coalesce(o_orderkey, row_id) AS row_id, o_totalprice, o_orderpriority, label
FROM orders FULL OUTER JOIN scored ON o_orderkey = row_id""",
    "median_mode_impute": f"""WITH {GAPS},
sizes AS (SELECT size, count(*) AS n FROM gaps WHERE size IS NOT NULL GROUP BY size)
SELECT row_id,
       coalesce(CAST(n_items AS DOUBLE), (SELECT median(n_items) FROM gaps)) AS n_items,
       coalesce(qty, (SELECT median(qty) FROM gaps)) AS qty,
       coalesce(size, (SELECT size FROM sizes ORDER BY n DESC, size LIMIT 1)) AS size, o_orderpriority
FROM gaps""",
    "standardize": f"""WITH {ORDERS}, moments AS (SELECT {', '.join(
        f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in NUMERIC)}
  FROM orders_scored)
SELECT row_id, {', '.join(
        f'round(({c} - m_{c}) / s_{c}, 6) AS {c}' for c in NUMERIC)}
FROM orders_scored, moments""",
    "prepared_features": f"""WITH {ORDERS}, moments AS (SELECT {', '.join(
        f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in NUMERIC)} FROM orders_scored)
SELECT row_id, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) AS v{i}' for i, c in enumerate(NUMERIC))}, {', '.join(
        f"CAST({c} = '{v}' AS DOUBLE) AS v{i}" for i, (c, v) in enumerate(CATEGORIES, len(NUMERIC)))}
FROM orders_scored, moments""",
    "one_hot": f"""WITH {GAPS}
SELECT row_id, o_orderstatus, size, {', '.join(
        f"CAST(o_orderstatus = '{v}' AS INTEGER) AS o_orderstatus_{v}" for v in 'FOP')},
       CAST(coalesce(size = 'large', false) AS INTEGER) AS size_large,
       CAST(coalesce(size = 'medium', false) AS INTEGER) AS size_medium
FROM gaps""",
    "permutation_importance_scorecard": f"WITH {SCORED}, "
    + _importance(["n_items", "dc", "qty"], _score("0.7", "0.12")),
    "model_registry": f"""WITH {MODEL_METRICS}, {_FILES}, {_folded('files')}
SELECT 'candidate' AS stage, model, 'pr_auc' AS selection_metric, pr_auc,
       (SELECT sha256 FROM folded) AS artifact_sha256, 16 AS version_length FROM model_metrics""",
    "artifact_digest": f"WITH {_FILES}, {_folded('files')} SELECT sha256 FROM folded",
    "corpus_digest": f"WITH texts AS (SELECT sha256(text) AS d FROM documents), {_folded('texts')} SELECT sha256 FROM folded",
    "train_logistic": f"""{_MODEL_ROWS}
SELECT CAST(t.k AS INTEGER) AS term, 0.0::DOUBLE AS gradient, c.* FROM range(-1, 17) t(k), (
  SELECT count(*) FILTER (WHERE split = 'train' AND label = 0) AS train_0,
         count(*) FILTER (WHERE split = 'train' AND label = 1) AS train_1,
         count(*) FILTER (WHERE split = 'test' AND label = 0) AS test_0,
         count(*) FILTER (WHERE split = 'test' AND label = 1) AS test_1 FROM split_rows) c""",
    "boosting_first_round": f"""{_MODEL_ROWS}
SELECT count(*) AS train_rows, count(*) AS rows_met, round(avg(2.0::DOUBLE * label - 1.0::DOUBLE), 6) AS mean_sign, 0.0::DOUBLE AS largest_gap, true AS splits
FROM split_rows WHERE split = 'train'""",
    "monitoring_bundle": f"""WITH {ORDERS}, long_drift AS ({_long('orders_scored', DRIFT_COLUMNS)}), {_psi('long_drift')},
drifts AS (SELECT *, {STATUS} FROM psi),
current_orders AS (SELECT * FROM orders_scored WHERE sample = 'current'),
slices AS (WITH {_slices('current_orders', ['o_orderpriority', 'c_mktsegment', 'o_orderstatus'])})
SELECT 'prediction_drift' AS section, NULL AS item, NULL AS slice, 'psi' AS field, psi AS value, NULL AS text FROM drifts WHERE feature = 'p'
UNION ALL SELECT 'prediction_drift', NULL, NULL, 'reference_mean', round(ref_mean, 6), NULL FROM drifts WHERE feature = 'p'
UNION ALL SELECT 'prediction_drift', NULL, NULL, 'current_mean', round(cur_mean, 6), NULL FROM drifts WHERE feature = 'p'
UNION ALL SELECT 'prediction_drift', NULL, NULL, 'status', NULL, status FROM drifts WHERE feature = 'p'
UNION ALL SELECT 'feature_drift', feature, NULL, 'psi', psi, NULL FROM drifts WHERE feature <> 'p'
UNION ALL SELECT 'feature_drift', feature, NULL, 'status', NULL, status FROM drifts WHERE feature <> 'p'
UNION ALL SELECT 'thresholds', NULL, NULL, 'watch_psi', 0.10::DOUBLE, NULL
UNION ALL SELECT 'thresholds', NULL, NULL, 'alert_psi', 0.25::DOUBLE, NULL
UNION ALL """
    + " UNION ALL ".join(
        f"SELECT 'governance_slices', slice_column, value, '{f}', CAST({f} AS DOUBLE), NULL FROM slices"
        for f in ("rows", "observed_default_rate", "predicted_default_rate", "pr_auc")
    ),
    "text_roundtrip": """WITH uneven AS (SELECT doc_id, lang, CASE doc_id % 8 WHEN 0 THEN ' ' || text || ' ' WHEN 1 THEN '"' || text || '"'
  WHEN 2 THEN text || chr(92) WHEN 3 THEN text || chr(13) || chr(10) || 'x' WHEN 4 THEN '' WHEN 5 THEN NULL
  WHEN 6 THEN chr(92) || '"' || text ELSE text END AS text FROM documents)
SELECT doc_id, lang, length(text) AS n_chars, sha256(text) AS sha256 FROM uneven""",
    "dataset_load_rejects": """WITH fields AS (SELECT o_orderkey AS k, o_orderkey % 7 = 0 AS longer, o_orderkey % 11 = 0 AS unknown,
  CAST(o_custkey AS VARCHAR) AS c, o_orderpriority || ', ' || o_orderstatus AS name, CAST(o_orderstatus = 'F' AS INTEGER) AS y FROM orders)
SELECT k AS row_id, CAST(c AS INTEGER) AS limit_bal, name, y AS default_next_month, NULL AS line, NULL AS reason
FROM fields WHERE NOT longer AND NOT unknown
UNION ALL SELECT NULL, NULL, NULL, NULL, k || ',' || CASE WHEN unknown THEN 'n/a' ELSE c END || ',"' || name || '",' || y || CASE WHEN longer THEN ',more' ELSE '' END,
  CASE WHEN longer THEN 'number of fields' ELSE 'type of limit_bal' END FROM fields WHERE longer OR unknown""",
    "features_and_target": f"WITH {SCORED} SELECT row_id, n_items, qty, label AS default_next_month FROM scored",
    "column_partition": """SELECT 'o_totalprice' AS name, 'numeric' AS kind, 0 AS place, count(DISTINCT o_totalprice) AS values FROM orders
UNION ALL SELECT 'o_custkey', 'numeric', 1, count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'o_orderpriority', 'categorical', 2, count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'o_orderstatus', 'categorical', 3, count(DISTINCT o_orderstatus) FROM orders""",
    "code_impute": f"""WITH {GAPS}, codes AS (SELECT n_items, count(*) AS n FROM gaps WHERE n_items IS NOT NULL GROUP BY n_items)
SELECT row_id, coalesce(n_items, (SELECT n_items FROM codes ORDER BY n DESC, n_items LIMIT 1)) || '.0' AS code FROM gaps""",
    "run_log": f"""WITH {MODEL_METRICS}
SELECT 'risk-' || model AS run, 'param' AS kind, 'selected_model' AS key, model AS value FROM model_metrics
UNION ALL SELECT 'risk-' || model, 'param', 'selection_metric', 'pr_auc' FROM model_metrics
UNION ALL """
    + " UNION ALL ".join(
        f"SELECT 'risk-' || model, 'metric', '{m}', CAST({m} AS VARCHAR) FROM model_metrics" for m in _METRICS
    ),
}
