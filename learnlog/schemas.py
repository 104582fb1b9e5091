"""Input schemas and the ordered feature lists.

Identifiers are 64-bit and counters are never narrowed, so no count can wrap
and no half-precision value can overflow.
"""

from pyspark.sql import types as T

TARGET = "answered_correctly"
NOT_APPLICABLE = -1

INTERACTION_COLUMNS = [
    "row_id",
    "timestamp",
    "user_id",
    "content_id",
    "content_type_id",
    "task_container_id",
    "answered_correctly",
    "prior_question_elapsed_time",
    "prior_question_had_explanation",
]


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Whole-file layouts, in file order; readers select the used columns from them.
INTERACTION_FILE = _schema(
    ("row_id", T.LongType()),
    ("timestamp", T.LongType()),
    ("user_id", T.LongType()),
    ("content_id", T.LongType()),
    ("content_type_id", T.IntegerType()),
    ("task_container_id", T.LongType()),
    ("user_answer", T.IntegerType()),
    ("answered_correctly", T.IntegerType()),
    ("prior_question_elapsed_time", T.DoubleType()),
    ("prior_question_had_explanation", T.BooleanType()),
)
QUESTION_FILE = _schema(
    ("question_id", T.LongType()),
    ("bundle_id", T.LongType()),
    ("correct_answer", T.IntegerType()),
    ("part", T.IntegerType()),
    ("tags", T.StringType()),
)
LECTURE_FILE = _schema(
    ("lecture_id", T.LongType()),
    ("tag", T.IntegerType()),
    ("part", T.IntegerType()),
    ("type_of", T.StringType()),
)
COMMUNITY_FILE = _schema(
    ("position", T.LongType()),
    ("question_id", T.LongType()),
    ("community", T.IntegerType()),
)

# --- fixed values: lecture categories, constants of the fills -----------------
LECTURE_PARTS = [1, 2, 3, 4, 5, 6, 7]
LECTURE_TYPES = ["concept", "intention", "solving_question", "starter"]
LECTURE_FLAGS = [f"part_{p}" for p in LECTURE_PARTS] + [f"type_of_{t}" for t in LECTURE_TYPES]

MISSING_TAGS = "188"
TAG_BAND_WIDTH = 32
TAG_BANDS = [0, 1, 2, 3, 4, 5]
TAG_COLUMNS = [f"tags{band}" for band in TAG_BANDS]
FIRST_ACCURACY = 0.67
MS_PER_HOUR = 3600000

# --- fixed values: ordered model inputs ---------------------------------------
FEATURES = [
    "timestamp",
    "user_interaction_count",
    "user_interaction_timestamp_mean",
    "lagtime",
    "lagtime2",
    "lagtime3",
    "content_id",
    "task_container_id",
    "user_lecture_sum",
    "user_lecture_lv",
    "prior_question_elapsed_time",
    "delta_prior_question_elapsed_time",
    "user_correctness",
    "user_uncorrect_count",
    "user_correct_count",
    "content_correctness",
    "content_correctness_std",
    "content_correct_count",
    "content_uncorrect_count",
    "content_elapsed_time_mean",
    "content_had_explanation_mean",
    "content_explation_false_mean",
    "content_explation_true_mean",
    "task_container_correctness",
    "task_container_std",
    "task_container_cor_count",
    "task_container_uncor_count",
    "attempt_no",
    "part",
    "part_correctness_mean",
    "part_correctness_std",
    "part_uncor_count",
    "part_cor_count",
    "tags0",
    "tags1",
    "tags2",
    "tags3",
    "tags4",
    "tags5",
    "part_bundle_id",
    "content_sub_bundle",
    "prior_question_had_explanation",
    "explanation_mean",
    "explanation_false_count",
    "explanation_true_count",
]
# The tuning runs leave one target encoding out.
FEATURES_TUNING = [name for name in FEATURES if name != "content_correctness"]

# --- fixed values: output columns of the two feature tables --------------------
HISTORY_COLUMNS = [
    "timestamp",
    "user_id",
    "content_id",
    "content_type_id",
    "task_container_id",
    "answered_correctly",
    "prior_question_elapsed_time",
    "prior_question_had_explanation",
    "user_interaction_count",
    "user_interaction_timestamp_mean",
    "user_lecture_sum",
    "user_lecture_lv",
    "attempt_no",
    "lagtime",
    "lagtime2",
    "lagtime3",
    "delta_prior_question_elapsed_time",
    "user_correctness",
    "user_correct_count",
    "user_uncorrect_count",
    "explanation_mean",
    "explanation_true_count",
    "explanation_false_count",
    "task_container_uncor_count",
    "task_container_cor_count",
    "task_container_std",
    "task_container_correctness",
]
QUESTION_COLUMNS = [
    "content_id",
    "bundle_id",
    "part",
    "content_sub_bundle",
    "tags0",
    "tags1",
    "tags2",
    "tags3",
    "tags4",
    "tags5",
    "part_bundle_id",
    "community",
    "content_explation_false_mean",
    "content_explation_true_mean",
    "content_correctness",
    "content_correctness_std",
    "content_uncorrect_count",
    "content_correct_count",
    "content_elapsed_time_mean",
    "content_had_explanation_mean",
    "part_correctness_mean",
    "part_correctness_std",
    "part_uncor_count",
    "part_cor_count",
    "bundle_correctness_mean",
]
