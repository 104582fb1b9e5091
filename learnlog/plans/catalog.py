"""One named query per operator, each over the driver's whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog import schemas
from learnlog.functions import columns as fn
from learnlog.ml import boosting, gbt, nodes, prep, search
from learnlog.operators import encodings, history, lectures, metrics, questions, splits
from learnlog.plans import matrix
from learnlog.sources import fixtures, readers, sinks
from learnlog.sources.tables import materialize, new_table

SEED = 2020
SAMPLE_ROWS = 4000
ROUNDS, STUMP_STEP = 5, 0.3  # of the boosted stumps that SQL repeats
Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round columns whose last bits depend on the order of summation."""
    return history.replaced(df, {name: f"round({name}, {digits})" for name in names})


HOURS = ["lagtime", "lagtime2", "lagtime3"]
CONTENT_FLOATS = [
    "content_explation_false_mean",
    "content_explation_true_mean",
    "content_correctness_std",
    "content_elapsed_time_mean",
    "content_had_explanation_mean",
]
PART_FLOATS = ["part_correctness_mean", "part_correctness_std"]


def _log(spark, d):
    return fixtures.interactions(spark, d)


def _contents(spark, d):
    log = _log(spark, d)
    return encodings.content_stats(encodings.content_sums(log), history.overall_sums(log))


def _matrix(spark, d, features=None):
    return matrix.training_matrix(
        _log(spark, d), fixtures.questions(spark, d), fixtures.communities(spark, d), features
    )


def _from_log(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(_log(spark, d))


def _from_questions(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(fixtures.questions(spark, d))


# --- filters and projections ------------------------------------------------------


def fill_global_mean(log: DataFrame) -> DataFrame:
    runs = history.user_runs(log)
    means = matrix.fit_means(runs)
    rows = history.add_elapsed(history.add_lagtimes(runs, means), means)
    rows = rows.select(
        "row_id", "prior_question_elapsed_time", *HOURS, "delta_prior_question_elapsed_time"
    )
    return rounded(rounded(rows, 8, *HOURS), 6, "prior_question_elapsed_time")


def cast_schema(log: DataFrame) -> DataFrame:
    kinds = {
        "content_type_id": "int",
        "answered_correctly": "int",
        "timestamp": "double",
        "prior_question_elapsed_time": "long",
        "prior_question_had_explanation": "int",
    }
    columns = ["row_id", "user_id", *kinds]
    return matrix.cast_columns(log.select(*columns), kinds)


def feature_select(log: DataFrame) -> DataFrame:
    renamed = log.withColumnRenamed("row_id", "interaction_id").drop("content_type_id")
    return renamed.select(
        "interaction_id", "timestamp", "content_id", "task_container_id", schemas.TARGET
    )


# --- joins ------------------------------------------------------------------------


def lookup_task_container(log: DataFrame) -> DataFrame:
    rows = encodings.with_container_stats(history.answered(log), log)
    rows = rows.select(
        "row_id",
        "task_container_id",
        "task_container_uncor_count",
        "task_container_cor_count",
        "task_container_std",
        "task_container_correctness",
    )
    return rounded(rows, 6, "task_container_std")


def lookup_question_stats(spark: SparkSession, d: str) -> DataFrame:
    contents = matrix.fit_log(_log(spark, d))[1]
    rows = questions.with_question_stats(fixtures.questions(spark, d), contents)
    return rounded(
        rows.drop("tags"), 6, *CONTENT_FLOATS, *PART_FLOATS, "bundle_correctness_mean"
    )


def join_explanation_means(spark: SparkSession, d: str) -> DataFrame:
    pivot = encodings.explanation_pivot(_log(spark, d))
    rows = questions.with_content_stats(fixtures.questions(spark, d), pivot)
    return rows.select(
        "content_id", "bundle_id", "content_explation_false_mean", "content_explation_true_mean"
    )


def holdout_user_rows(log: DataFrame) -> DataFrame:
    rows = history.answered(log)
    users = splits.sample_users(rows, splits.USER_SHARE, SEED)
    return splits.rows_of_users(rows, users).select("row_id", "user_id")


def drop_rows_anti(log: DataFrame) -> DataFrame:
    rows = history.answered(log)
    valid = splits.sample_rows(rows, splits.ROW_SHARE, SEED)
    return splits.drop_rows(rows, valid).select("row_id", "user_id")


# --- aggregates -------------------------------------------------------------------


def content_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = _contents(spark, d).select(
        "content_id",
        "content_correctness",
        "content_correctness_std",
        "content_uncorrect_count",
        "content_correct_count",
    )
    return rounded(rows, 6, "content_correctness_std")


def _answered_questions(spark: SparkSession, d: str) -> DataFrame:
    return questions.with_content_stats(fixtures.questions(spark, d), _contents(spark, d))


def part_correctness(spark: SparkSession, d: str) -> DataFrame:
    rows = questions.part_stats(_answered_questions(spark, d))
    return rounded(rows.select("part", *PART_FLOATS), 6, *PART_FLOATS)


def part_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = questions.part_stats(_answered_questions(spark, d))
    return rows.select("part", "part_uncor_count", "part_cor_count")


def bundle_correctness(spark: SparkSession, d: str) -> DataFrame:
    rows = questions.bundle_stats(_answered_questions(spark, d))
    return rounded(
        rows.select("bundle_id", "bundle_correctness_mean"), 6, "bundle_correctness_mean"
    )


def roc_auc(log: DataFrame) -> DataFrame:
    """How well the accuracy so far ranks the next answer."""
    rows = history.add_prior_accuracy(history.user_runs(log))
    scored = rows.select(F.col("user_correctness").alias("score"), schemas.TARGET)
    return rounded(metrics.roc_auc(scored), 9, "auc")


# --- windows ----------------------------------------------------------------------


def _counts(column: str) -> Query:
    return _from_log(lambda log: history.interaction_counts(log).select("row_id", column))


def _lagtime(column: str) -> Query:
    def build(log: DataFrame) -> DataFrame:
        runs = history.user_runs(log)
        rows = history.add_lagtimes(runs, matrix.fit_means(runs))
        return rounded(rows.select("row_id", column), 8, column)

    return _from_log(build)


def delta_elapsed(log: DataFrame) -> DataFrame:
    runs = history.user_runs(log)
    rows = history.add_elapsed(runs, matrix.fit_means(runs))
    return rows.select("row_id", "delta_prior_question_elapsed_time")


def user_prior_accuracy(log: DataFrame) -> DataFrame:
    rows = history.add_prior_accuracy(history.user_runs(log))
    return rows.select(
        "row_id", "user_id", "user_correct_count", "user_uncorrect_count", "user_correctness"
    )


def explanation_running(log: DataFrame) -> DataFrame:
    rows = history.add_explanation_counts(history.user_runs(log))
    return rows.select(
        "row_id", "explanation_mean", "explanation_true_count", "explanation_false_count"
    )


# --- splits -----------------------------------------------------------------------


def valid_union(log: DataFrame) -> DataFrame:
    """Both kinds of validation rows of the whole log, from one split, written."""
    marked = splits.mark_holdout(history.answered(log), SEED)
    marked = marked.where("split = 'valid'").select("row_id", "user_id", "valid_kind")
    marked = materialize(marked, "holdout")
    kind = F.col("valid_kind")
    columns = ["row_id", "user_id"]
    return splits.valid_union(
        marked.where(kind == "random").select(*columns),
        marked.where(kind == "new_user").select(*columns),
    )


def holdout_split(spark: SparkSession, d: str) -> DataFrame:
    rows = matrix.labelled_questions(_log(spark, d), fixtures.questions(spark, d))
    return splits.holdout_split(rows, SEED).select(
        "row_id", "user_id", "content_id", "part", "split", "valid_kind"
    )


def repeated_folds(log: DataFrame) -> DataFrame:
    folds = splits.repeated_folds(history.answered(log), SEED)
    return folds.select("fold", "row_id", "split", "valid_kind")


def split_counts(log: DataFrame) -> DataFrame:
    return splits.split_counts(splits.repeated_folds(history.answered(log), SEED))


# --- models -----------------------------------------------------------------------


def _labelled(spark: SparkSession, d: str, choose: matrix.Choice) -> DataFrame:
    return matrix.fit_labelled(
        _log(spark, d), fixtures.questions(spark, d), fixtures.communities(spark, d), choose=choose
    )


def _ids(spark: SparkSession, d: str) -> DataFrame:
    """The ids that samples are cut from: two columns of the log, no feature."""
    return history.answered(_log(spark, d)).select("row_id")


def _holdout(spark: SparkSession, d: str) -> DataFrame:
    """The model inputs of one split, written once: fits read them many times."""
    ids = _ids(spark, d)
    rows = _labelled(spark, d, lambda r: splits.holdout_split(r, SEED, ids=ids))
    return gbt.assemble(rows, schemas.FEATURES)


def _folds(spark: SparkSession, d: str) -> DataFrame:
    """The model inputs of all folds, written once."""
    ids = _ids(spark, d)
    rows = _labelled(spark, d, lambda r: splits.repeated_folds(r, SEED, ids=ids))
    return gbt.assemble(rows, schemas.FEATURES)


def gbt_fit(spark: SparkSession, d: str) -> DataFrame:
    """One model per fold, and its AUC on the rows it was and was not trained on."""
    rows = _folds(spark, d)
    scored = gbt.score_folds(gbt.fit_folds(rows), rows)
    return metrics.roc_auc(scored, within=["fold", "split"])


def gbt_category_stump(spark: SparkSession, d: str) -> DataFrame:
    """One split of ``part`` as a category: which of its values go left, SQL can tell."""
    rows = matrix.labelled_questions(_log(spark, d), fixtures.questions(spark, d))
    split = splits.holdout_split(rows, SEED, ids=_ids(spark, d))
    rows = gbt.assemble(split, ["part"], categories=["part"])
    model = gbt.fit(rows, {"maxIter": 1, "maxDepth": 1, "stepSize": 1.0})
    scored = gbt.score(model, rows.where(F.col("split") == "valid"))
    return rounded(scored.select("row_id", schemas.TARGET, "score"), 6, "score")


def gbt_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Stumps on ``part`` alone, a few rounds in every fold: the AUC of each round and split,
    which SQL can tell."""
    rows = matrix.labelled_questions(_log(spark, d), fixtures.questions(spark, d))
    folds = gbt.assemble(splits.repeated_folds(rows, SEED, ids=_ids(spark, d)), ["part"])
    stumps = {"maxIter": ROUNDS, "maxDepth": 1, "stepSize": STUMP_STEP}
    states = gbt.fit_fold_states(folds, stumps, patience=ROUNDS)
    return rounded(gbt.rounds_table(states, spark), 9, "auc")


def gbt_score(spark: SparkSession, d: str) -> DataFrame:
    rows = _holdout(spark, d)
    scored = gbt.score(gbt.fit(rows), rows.where(F.col("split") == "valid"))
    return scored.select("row_id", schemas.TARGET, "score")


def gbt_stump(spark: SparkSession, d: str) -> DataFrame:
    """One tree of depth 1 on ``part`` alone, whose scores SQL can tell."""
    questions = fixtures.questions(spark, d)
    rows = matrix.labelled_questions(_log(spark, d), questions)
    rows = gbt.assemble(splits.holdout_split(rows, SEED, ids=_ids(spark, d)), ["part"])
    model = gbt.fit(rows, {"maxIter": 1, "maxDepth": 1, "stepSize": 1.0})
    scored = gbt.score(model, rows.where(F.col("split") == "valid"))
    return rounded(scored.select("row_id", schemas.TARGET, "score"), 6, "score")


def gbt_reloaded(spark: SparkSession, d: str) -> DataFrame:
    """Stumps on ``part`` alone, saved as a node table, loaded again and scored from it."""
    rows = matrix.labelled_questions(_log(spark, d), fixtures.questions(spark, d))
    rows = gbt.assemble(splits.holdout_split(rows, SEED, ids=_ids(spark, d)), ["part"])
    state = gbt.fit_state(rows, {"maxIter": ROUNDS, "maxDepth": 1, "stepSize": STUMP_STEP})
    model = boosting.cut(state, {"stepSize": STUMP_STEP}, ROUNDS)
    path = new_table(spark, "nodes")
    nodes.save(model, spark, path)
    scored = nodes.score(rows.where(F.col("split") == "valid"), nodes.load(spark, path))
    return rounded(scored.select("row_id", schemas.TARGET, "score"), 6, "score")


def preprocess(spark: SparkSession, d: str) -> DataFrame:
    """Imputed and scaled inputs and the one-hot flag, before the classifier."""
    columns = ["row_id", *prep.NUMERIC, prep.FLAG]
    rows = materialize(_matrix(spark, d).select(*columns), "matrix")
    fitted = prep.preprocessor().fit(rows)
    return rounded(prep.unpack(fitted.transform(rows)), 6, *prep.SCALED)


def param_search(spark: SparkSession, d: str) -> DataFrame:
    points = search.random_points(search.BOUNDS, search.TRIALS, SEED)
    return search.run(_holdout(spark, d), points)


def best_params(spark: SparkSession, d: str) -> DataFrame:
    return search.best(param_search(spark, d))


def rung_search(spark: SparkSession, d: str) -> DataFrame:
    """The large search, half of the points dropped at every rung."""
    points = search.random_points(search.RUNG_BOUNDS, search.RUNG_TRIALS, SEED)
    return search.run_rungs(_holdout(spark, d), points)


def write_features(spark: SparkSession, d: str) -> DataFrame:
    """The folds as a feature table with a folder per fold and split, read back."""
    folds = splits.repeated_folds(history.answered(_log(spark, d)), SEED)
    folds = folds.select("row_id", schemas.TARGET, "valid_kind", "fold", "split")
    path = new_table(spark, "features")
    sinks.write_features(folds, path, ["fold", "split"])
    return spark.read.schema(folds.schema).parquet(path)


def _scanned(
    view: Callable[[SparkSession, str], DataFrame],
    layout: T.StructType,
    read: Callable[[SparkSession, str, str], DataFrame],
) -> Query:
    """The view written as the workload's CSV file and read back by its reader."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = view(spark, d)
        file = rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in layout
            ]
        )
        path = new_table(spark, "csv")
        file.write.csv(path, header=True, emptyValue="")
        return read(spark, path, "csv")

    return query


def training_matrix(spark: SparkSession, d: str) -> DataFrame:
    floats = [*CONTENT_FLOATS, *PART_FLOATS, "task_container_std", "prior_question_elapsed_time"]
    return rounded(rounded(_matrix(spark, d), 8, *HOURS), 6, *floats)


def tuning_matrix(spark: SparkSession, d: str) -> DataFrame:
    floats = [*CONTENT_FLOATS, *PART_FLOATS, "task_container_std", "prior_question_elapsed_time"]
    rows = _matrix(spark, d, schemas.FEATURES_TUNING)
    return rounded(rounded(rows, 8, *HOURS), 6, *floats)


def history_features(log: DataFrame) -> DataFrame:
    rows = matrix.fit_history(log)
    floats = ["task_container_std", "prior_question_elapsed_time"]
    return rounded(rounded(rows, 8, *HOURS), 6, *floats)


def question_features(spark: SparkSession, d: str) -> DataFrame:
    encoded = matrix.fit(
        _log(spark, d), fixtures.questions(spark, d), fixtures.communities(spark, d)
    )
    return rounded(encoded.questions, 6, *CONTENT_FLOATS, *PART_FLOATS, "bundle_correctness_mean")


def queries() -> dict[str, Query]:
    return {
        # sources
        "scan_interactions": _scanned(
            fixtures.interactions, schemas.INTERACTION_FILE, readers.read_interactions
        ),
        "scan_lectures": _scanned(fixtures.lectures, schemas.LECTURE_FILE, readers.read_lectures),
        "scan_questions": _scanned(
            fixtures.questions, schemas.QUESTION_FILE, readers.read_questions
        ),
        "scan_communities": _scanned(
            fixtures.communities, schemas.COMMUNITY_FILE, readers.read_communities
        ),
        # filters and projections
        "filter_lectures": _from_log(lectures.lecture_rows),
        "filter_answered": _from_log(history.answered),
        "repeat_attempts": _from_log(history.repeat_attempts),
        "fill_constant": _from_log(
            lambda log: log.selectExpr(
                "row_id", f"{fn.had_explanation()} as prior_question_had_explanation"
            )
        ),
        "fill_tags": _from_questions(
            lambda q: q.selectExpr("question_id", f"{fn.filled_tags()} as tags")
        ),
        "fill_global_mean": _from_log(fill_global_mean),
        "lecture_type_normalize": lambda spark, d: lectures.normalize_types(
            fixtures.lectures(spark, d)
        ),
        "lecture_one_hot": lambda spark, d: lectures.one_hot(fixtures.lectures(spark, d)),
        "ms_to_hours": _from_log(
            lambda log: history.answered(log).selectExpr(
                "row_id", f"{fn.hours('timestamp')} as timestamp"
            )
        ),
        "cast_schema": _from_log(cast_schema),
        "part_bundle_key": _from_questions(
            lambda q: q.selectExpr("question_id", f"{fn.part_bundle_key()} as part_bundle_id")
        ),
        "feature_select": _from_log(feature_select),
        # joins
        "join_lectures": lambda spark, d: lectures.join_lectures(
            _log(spark, d), fixtures.lectures(spark, d)
        ).select("row_id", "user_id", "content_id", *schemas.LECTURE_FLAGS),
        "lookup_task_container": _from_log(lookup_task_container),
        "lookup_question_stats": lookup_question_stats,
        "join_communities": lambda spark, d: questions.join_communities(
            fixtures.questions(spark, d), fixtures.communities(spark, d)
        ),
        "join_explanation_means": join_explanation_means,
        "holdout_user_rows": _from_log(holdout_user_rows),
        "drop_rows_anti": _from_log(drop_rows_anti),
        "join_questions": lambda spark, d: matrix.labelled_questions(
            _log(spark, d), fixtures.questions(spark, d)
        ).select("row_id", "user_id", "content_id", "bundle_id", "part", "tags"),
        # aggregates
        "user_lecture_profile": lambda spark, d: lectures.lecture_profile(
            _log(spark, d), fixtures.lectures(spark, d)
        ),
        "user_lecture_totals": _from_log(history.lecture_totals),
        "content_explanation_pivot": _from_log(encodings.explanation_pivot),
        "attempt_totals": _from_log(history.attempt_totals),
        "user_last_ts": _from_log(history.last_timestamps),
        "user_prev_ts": _from_log(history.previous_timestamps),
        "user_last_elapsed": _from_log(
            lambda log: rounded(
                history.last_elapsed(log, history.overall_sums(log)), 6, "prior_question_elapsed_time"
            )
        ),
        "user_explanation_totals": _from_log(history.explanation_totals),
        "task_container_stats": _from_log(
            lambda log: rounded(
                encodings.container_stats(encodings.container_sums(log)), 6, "task_container_std"
            )
        ),
        "bundle_size": _from_questions(
            lambda q: questions.with_bundle_size(q).select(
                "question_id", "bundle_id", "content_sub_bundle"
            )
        ),
        "content_stats": content_summary,
        "content_elapsed_mean": lambda spark, d: rounded(
            _contents(spark, d).select("content_id", "content_elapsed_time_mean"),
            6,
            "content_elapsed_time_mean",
        ),
        "content_explanation_mean": lambda spark, d: _contents(spark, d).select(
            "content_id", "content_had_explanation_mean"
        ),
        "part_correctness": part_correctness,
        "part_counts": part_counts,
        "bundle_correctness": bundle_correctness,
        "global_means": _from_log(
            lambda log: rounded(
                history.global_means(log),
                4,
                "elapsed_mean",
                "lagtime_mean",
                "lagtime2_mean",
                "lagtime3_mean",
                "delta_mean",
            )
        ),
        "distinct_users": _from_log(lambda log: splits.distinct_users(history.answered(log))),
        "split_counts": _from_log(split_counts),
        "roc_auc": _from_log(roc_auc),
        # windows
        "user_interaction_count": _counts("user_interaction_count"),
        "user_interaction_ts_mean": _counts("user_interaction_timestamp_mean"),
        "user_lecture_sum": _counts("user_lecture_sum"),
        "user_lecture_lv": _counts("user_lecture_lv"),
        "attempt_no": _from_log(
            lambda log: history.user_runs(log).select(
                "row_id", "user_id", "content_id", "attempt_no"
            )
        ),
        "lagtime": _lagtime("lagtime"),
        "lagtime2": _lagtime("lagtime2"),
        "lagtime3": _lagtime("lagtime3"),
        "delta_elapsed": _from_log(delta_elapsed),
        "user_prior_accuracy": _from_log(user_prior_accuracy),
        "explanation_running": _from_log(explanation_running),
        # scalar functions
        "tag_bands": _from_questions(
            lambda q: questions.tag_bands(q).select("question_id", *schemas.TAG_COLUMNS)
        ),
        "label_encode": _from_questions(
            lambda q: questions.label_encode(
                questions.tag_bands(q), schemas.TAG_COLUMNS
            ).select("question_id", *schemas.TAG_COLUMNS)
        ),
        "safe_ratio": _from_log(
            lambda log: history.explanation_totals(log).selectExpr(
                "user_id", f"{fn.ratio('(count - sum)', 'sum')} as ratio"
            )
        ),
        # samples and splits
        "valid_union": _from_log(valid_union),
        "sample_n": _from_log(
            lambda log: splits.sample_n(history.answered(log), SAMPLE_ROWS, SEED).select(
                "row_id", "user_id"
            )
        ),
        "sample_users": _from_log(
            lambda log: splits.sample_users(history.answered(log), splits.USER_SHARE, SEED)
        ),
        "sample_rows": _from_log(
            lambda log: splits.sample_rows(
                history.answered(log), splits.ROW_SHARE, SEED
            ).select("row_id", "user_id")
        ),
        "holdout_split": holdout_split,
        "repeated_folds": _from_log(repeated_folds),
        # feature tables and models
        "history_features": _from_log(history_features),
        "question_features": question_features,
        "training_matrix": training_matrix,
        "tuning_matrix": tuning_matrix,
        "gbt_fit": gbt_fit,
        "gbt_score": gbt_score,
        "gbt_stump": gbt_stump,
        "gbt_category_stump": gbt_category_stump,
        "gbt_rounds": gbt_rounds,
        "gbt_reloaded": gbt_reloaded,
        "write_features": write_features,
        "preprocess": preprocess,
        "param_search": param_search,
        "best_params": best_params,
        "rung_search": rung_search,
    }
