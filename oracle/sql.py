"""DuckDB SQL for every query that SQL can express, over the raw tables.

Each statement is built from the common table expressions it needs. The SQL
states the operators row by row (fill, then lag, then fill) and shares nothing
with the Spark plans.
"""

from oracle.inputs import COMMUNITIES, INTERACTIONS, LECTURES, QUESTIONS

SEED = 2020
SAMPLE_ROWS = 4000
ROUNDS, STUMP_STEP = 5, 0.3

ANSWERED = """
answered as (
  select * replace (coalesce(cast(prior_question_had_explanation as int), 0)
                    as prior_question_had_explanation)
  from interactions where answered_correctly <> -1)"""

COUNTED = """
counted as (
  select *,
    row_number() over w as user_interaction_count,
    timestamp / row_number() over w / 3600000.0 as user_interaction_timestamp_mean,
    cast(sum(content_type_id) over (w rows unbounded preceding) as bigint) as user_lecture_sum,
    sum(content_type_id) over (w rows unbounded preceding) / row_number() over w
      as user_lecture_lv
  from interactions window w as (partition by user_id order by row_id))"""

FILLED = """
elapsed_filled as (
  select * replace (coalesce(prior_question_elapsed_time,
                      (select avg(prior_question_elapsed_time) from answered))
                    as prior_question_elapsed_time)
  from answered)"""

LAGGED = """
gaps as (
  select row_id, prior_question_elapsed_time,
    timestamp - lag(timestamp, 1) over w as g1,
    timestamp - lag(timestamp, 2) over w as g2,
    timestamp - lag(timestamp, 3) over w as g3,
    prior_question_elapsed_time - lag(prior_question_elapsed_time) over w as d
  from elapsed_filled window w as (partition by user_id order by row_id)),
lagged as (
  select row_id, prior_question_elapsed_time,
    coalesce(g1, (select avg(g1) from gaps)) / 3600000.0 as lagtime,
    coalesce(g2, (select avg(g2) from gaps)) / 3600000.0 as lagtime2,
    coalesce(g3, (select avg(g3) from gaps)) / 3600000.0 as lagtime3,
    cast(trunc(coalesce(d, (select avg(d) from gaps))) as bigint)
      as delta_prior_question_elapsed_time
  from gaps)"""

PRIOR = """
prior as (
  select row_id, user_id, answered_correctly,
    cast(coalesce(sum(answered_correctly) over before, 0) as bigint) as user_correct_count,
    cast(count(*) over before - coalesce(sum(answered_correctly) over before, 0) as bigint)
      as user_uncorrect_count,
    coalesce(sum(answered_correctly) over before / nullif(count(*) over before, 0),
             cast(0.67 as double)) as user_correctness
  from answered
  window before as (partition by user_id order by row_id
                    rows between unbounded preceding and 1 preceding))"""

EXPLAINED = """
explained as (
  select row_id,
    sum(prior_question_had_explanation) over upto / count(*) over upto as explanation_mean,
    cast(sum(prior_question_had_explanation) over upto as bigint) as explanation_true_count,
    cast(count(*) over upto - sum(prior_question_had_explanation) over upto as bigint)
      as explanation_false_count
  from answered
  window upto as (partition by user_id order by row_id rows unbounded preceding))"""

ATTEMPTS = """
attempts as (
  select row_id, user_id, content_id,
    row_number() over (partition by user_id, content_id order by row_id) as attempt_no
  from answered)"""

CONTAINERS = """
containers as (
  select task_container_id,
    cast(count(*) - sum(answered_correctly) as bigint) as task_container_uncor_count,
    cast(sum(answered_correctly) as bigint) as task_container_cor_count,
    round(var_samp(answered_correctly), 6) as task_container_std,
    sum(answered_correctly) / count(*) as task_container_correctness
  from answered group by task_container_id)"""

CONTENTS = """
contents as (
  select content_id,
    avg(answered_correctly) filter (prior_question_had_explanation = 0)
      as content_explation_false_mean,
    avg(answered_correctly) filter (prior_question_had_explanation = 1)
      as content_explation_true_mean,
    sum(answered_correctly) / count(*) as content_correctness,
    var_samp(answered_correctly) as content_correctness_std,
    cast(count(*) - sum(answered_correctly) as bigint) as content_uncorrect_count,
    cast(sum(answered_correctly) as bigint) as content_correct_count,
    avg(prior_question_elapsed_time) as content_elapsed_time_mean,
    avg(prior_question_had_explanation) as content_had_explanation_mean
  from elapsed_filled group by content_id)"""

QUESTION_STATS = """
question_contents as (
  select question_id as content_id, bundle_id, part, c.* exclude (content_id)
  from questions q left join contents c on q.question_id = c.content_id),
parts as (
  select part,
    avg(content_correctness) as part_correctness_mean,
    var_samp(content_correctness) as part_correctness_std,
    cast(coalesce(sum(content_uncorrect_count), 0) as bigint) as part_uncor_count,
    cast(coalesce(sum(content_correct_count), 0) as bigint) as part_cor_count
  from question_contents group by part),
bundles as (
  select bundle_id, count(*) as content_sub_bundle,
    avg(content_correctness) as bundle_correctness_mean
  from question_contents group by bundle_id)"""

TAGS = """
bands as (
  select question_id, %s
  from (select question_id, string_split(coalesce(tags, '188'), ' ') as t from questions))""" % (
    ",\n    ".join(
        f"array_to_string(list_filter(t, lambda x: cast(x as int) >= {32 * b}"
        f" and cast(x as int) < {32 * (b + 1)}), ' ') as tags{b}"
        for b in range(6)
    )
)

CODES = """
codes as (
  select question_id, %s
  from bands)""" % (
    ",\n    ".join(f"dense_rank() over (order by tags{b}) - 1 as tags{b}" for b in range(6))
)

ROUNDED_STATS = """
    round(content_explation_false_mean, 6) as content_explation_false_mean,
    round(content_explation_true_mean, 6) as content_explation_true_mean,
    content_correctness,
    round(content_correctness_std, 6) as content_correctness_std,
    content_uncorrect_count, content_correct_count,
    round(content_elapsed_time_mean, 6) as content_elapsed_time_mean,
    round(content_had_explanation_mean, 6) as content_had_explanation_mean,
    round(part_correctness_mean, 6) as part_correctness_mean,
    round(part_correctness_std, 6) as part_correctness_std,
    part_uncor_count, part_cor_count"""

QUESTION_FEATURES = f"""
question_features as (
  select content_id, bundle_id, part, content_sub_bundle,
    tags0, tags1, tags2, tags3, tags4, tags5,
    part * 100000 + bundle_id as part_bundle_id,
    community, {ROUNDED_STATS},
    round(bundle_correctness_mean, 6) as bundle_correctness_mean
  from question_contents
  join codes on codes.question_id = content_id
  left join communities on communities.question_id = content_id
  join parts using (part) join bundles using (bundle_id))"""

HISTORY = """
history as (
  select a.row_id, a.timestamp / 3600000.0 as timestamp, a.user_id, a.content_id,
    a.content_type_id, a.task_container_id, a.answered_correctly,
    round(l.prior_question_elapsed_time, 6) as prior_question_elapsed_time,
    a.prior_question_had_explanation,
    user_interaction_count, user_interaction_timestamp_mean, user_lecture_sum, user_lecture_lv,
    attempt_no,
    round(lagtime, 8) as lagtime, round(lagtime2, 8) as lagtime2, round(lagtime3, 8) as lagtime3,
    delta_prior_question_elapsed_time,
    user_correctness, user_correct_count, user_uncorrect_count,
    explanation_mean, explanation_true_count, explanation_false_count,
    task_container_uncor_count, task_container_cor_count, task_container_std,
    task_container_correctness
  from answered a
  join counted n using (row_id) join lagged l using (row_id) join prior p using (row_id)
  join explained e using (row_id) join attempts t using (row_id)
  join containers c on a.task_container_id = c.task_container_id)"""

FEATURES = """timestamp, user_interaction_count, user_interaction_timestamp_mean,
    lagtime, lagtime2, lagtime3, h.content_id, task_container_id, user_lecture_sum,
    user_lecture_lv, prior_question_elapsed_time, delta_prior_question_elapsed_time,
    user_correctness, user_uncorrect_count, user_correct_count, content_correctness,
    content_correctness_std, content_correct_count, content_uncorrect_count,
    content_elapsed_time_mean, content_had_explanation_mean, content_explation_false_mean,
    content_explation_true_mean, task_container_correctness, task_container_std,
    task_container_cor_count, task_container_uncor_count, attempt_no, part,
    part_correctness_mean, part_correctness_std, part_uncor_count, part_cor_count,
    tags0, tags1, tags2, tags3, tags4, tags5, part_bundle_id, content_sub_bundle,
    prior_question_had_explanation, explanation_mean, explanation_false_count,
    explanation_true_count"""


def draw(kind: str, key: str, seed: str = str(SEED)) -> str:
    return f"md5(concat_ws(':', {seed}, '{kind}', {key}))"


def below(hashed: str, bound: str) -> str:
    return f"substring({hashed}, 1, 8) < '{bound}'"


NEW_USER = below(draw("users", "user_id"), "147ae148")
HELD_OUT = below(draw("holdout", "row_id"), "1999999a")
KIND = f"case when {NEW_USER} then 'new_user' when {HELD_OUT} then 'random' end"

FOLDS = """
sampled as (
  select fold, row_id, user_id
  from answered, generate_series(0, 4) as f(fold)
  qualify row_number() over (partition by fold order by %s, row_id) <= 12000000),
folds as (
  select cast(fold as int) as fold, row_id,
    case when %s then 'new_user' when %s then 'random' end as valid_kind
  from sampled)""" % (
    draw("rows", "row_id", "2020 + fold"),
    below(draw("users", "user_id", "2020 + fold"), "147ae148"),
    below(draw("holdout", "row_id", "2020 + fold"), "1999999a"),
)

_LOG = [INTERACTIONS]
_ANSWERED = [INTERACTIONS, ANSWERED]
_FILLED = [*_ANSWERED, FILLED]
_LAGGED = [*_FILLED, LAGGED]
_CONTENTS = [*_FILLED, CONTENTS]
_STATS = [*_CONTENTS, QUESTIONS, QUESTION_STATS]
_FEATURES = [*_STATS, COMMUNITIES, TAGS, CODES, QUESTION_FEATURES]
_HISTORY = [*_LAGGED, COUNTED, PRIOR, EXPLAINED, ATTEMPTS, CONTAINERS, HISTORY]
_MATRIX = [*_HISTORY, *_FEATURES[len(_FILLED) :]]


def _query(parts: list[str], body: str) -> str:
    return "with " + ",".join(parts) + "\n" + body


def _training(features: str) -> str:
    return _query(
        _MATRIX,
        f"""select row_id, {features}, answered_correctly
        from history h left join question_features q on h.content_id = q.content_id""",
    )


def boosted_stumps(rounds: int, step: float) -> str:
    """Tables ``m0`` to ``m<rounds>``: the margin of each part in each fold after each round,
    from ``counts`` with fold, part, valid, pos and neg."""
    parts = ["""
    train as (select fold, part, pos, neg from counts where not valid),
    m0 as (select distinct fold, part, cast(0 as double) as f from counts)"""]
    for r in range(1, rounds + 1):
        pull = "4 * pos / (1 + exp(2 * f)) - 4 * neg / (1 + exp(-2 * f))" if r > 1 else "pos - neg"
        parts.append(f"""
    g{r} as (select fold, part, pos + neg as n, {pull} as s from train join m{r - 1} using (fold, part)),
    c{r} as (
      select fold, (part + lead(part) over w) / 2 as cut, sum(n) over w as n1, sum(s) over w as s1,
        sum(n) over (partition by fold) as n, sum(s) over (partition by fold) as s
      from g{r} window w as (partition by fold order by part)),
    b{r} as (
      select distinct on (fold) fold, cut, s1 / n1 as low, (s - s1) / (n - n1) as high
      from c{r} where cut is not null
      order by fold, s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) desc, cut),
    m{r} as (
      select fold, part, f + {step if r > 1 else 1} * case when part <= cut then low else high end as f
      from m{r - 1} join b{r} using (fold))""")
    return ",".join(parts)


def round_aucs(rounds: int) -> str:
    """The AUC per fold, round and split after :func:`boosted_stumps`."""
    scored = " union all ".join(
        f"select fold, {r} as round, valid, f, pos, neg from counts join m{r} using (fold, part)"
        for r in range(1, rounds + 1)
    )
    return f"""
    scored as ({scored}),
    tied as (
      select fold, round, valid, f, sum(pos) as p, sum(neg) as n from scored group by all),
    ranked as (
      select *, sum(n) over (partition by fold, round, valid order by f) - n as below from tied)
    select cast(fold as int) as fold, cast(round as int) as round,
      case when valid then 'valid' else 'train' end as split,
      round(sum(p * (below + n / 2)) / nullif(sum(p) * sum(n), 0), 9) as auc
    from ranked group by all"""


_PART = "coalesce(cast(part as double), -1)"

_FLAG_VALUES = {
    **{f"part_{p}": f"part = {p}" for p in range(1, 8)},
    "type_of_concept": "type_of = 'concept'",
    "type_of_intention": "type_of = 'intention'",
    "type_of_solving_question": "type_of = 'solving question'",
    "type_of_starter": "type_of = 'starter'",
}
_FLAGS = ", ".join(f"cast({test} as int) as {name}" for name, test in _FLAG_VALUES.items())
_EVER = ", ".join(
    f"coalesce(max(cast({test} as int)), 0) as {name}" for name, test in _FLAG_VALUES.items()
)


def oracle_sql() -> dict[str, str]:
    lectures_join = "interactions left join lectures on content_id = lecture_id"
    return {
        "scan_interactions": _query(
            _LOG,
            """select row_id, timestamp, user_id, content_id, content_type_id,
            task_container_id, answered_correctly, prior_question_elapsed_time,
            prior_question_had_explanation from interactions""",
        ),
        "scan_lectures": _query([LECTURES], "select * from lectures"),
        "scan_questions": _query([QUESTIONS], "select * from questions"),
        "scan_communities": _query([COMMUNITIES], "select * from communities"),
        "filter_lectures": _query(_LOG, "select * from interactions where content_type_id = 1"),
        "filter_answered": _query(_ANSWERED, "select * from answered"),
        "repeat_attempts": _query(
            _ANSWERED,
            """select user_id, content_id, count(*) as sum from answered
            group by user_id, content_id having count(*) > 1""",
        ),
        "fill_constant": _query(
            _LOG,
            """select row_id, coalesce(cast(prior_question_had_explanation as int), 0)
            as prior_question_had_explanation from interactions""",
        ),
        "fill_tags": _query(
            [QUESTIONS], "select question_id, coalesce(tags, '188') as tags from questions"
        ),
        "fill_global_mean": _query(
            _LAGGED,
            """select row_id, round(prior_question_elapsed_time, 6)
            as prior_question_elapsed_time, round(lagtime, 8) as lagtime,
            round(lagtime2, 8) as lagtime2, round(lagtime3, 8) as lagtime3,
            delta_prior_question_elapsed_time from lagged""",
        ),
        "lecture_type_normalize": _query(
            [LECTURES],
            """select lecture_id, tag, part, case when type_of = 'solving question'
            then 'solving_question' else type_of end as type_of from lectures""",
        ),
        "lecture_one_hot": _query(
            [LECTURES], f"select lecture_id, tag, {_FLAGS} from lectures"
        ),
        "ms_to_hours": _query(
            _ANSWERED, "select row_id, timestamp / 3600000.0 as timestamp from answered"
        ),
        "cast_schema": _query(
            _LOG,
            """select row_id, user_id, content_type_id, answered_correctly,
            cast(timestamp as double) as timestamp,
            cast(trunc(prior_question_elapsed_time) as bigint) as prior_question_elapsed_time,
            cast(prior_question_had_explanation as int) as prior_question_had_explanation
            from interactions""",
        ),
        "part_bundle_key": _query(
            [QUESTIONS],
            """select question_id, cast(part as bigint) * 100000 + bundle_id as part_bundle_id
            from questions""",
        ),
        "feature_select": _query(
            _LOG,
            """select row_id as interaction_id, timestamp, content_id, task_container_id,
            answered_correctly from interactions""",
        ),
        "join_lectures": _query(
            [INTERACTIONS, LECTURES],
            f"select row_id, user_id, content_id, {_FLAGS} from {lectures_join} "
            "where content_type_id = 1",
        ),
        "lookup_task_container": _query(
            [*_ANSWERED, CONTAINERS],
            "select row_id, c.* from answered join containers c using (task_container_id)",
        ),
        "lookup_question_stats": _query(
            _STATS,
            f"""select content_id, bundle_id, part, content_sub_bundle, {ROUNDED_STATS},
            round(bundle_correctness_mean, 6) as bundle_correctness_mean
            from question_contents join parts using (part) join bundles using (bundle_id)""",
        ),
        "join_communities": _query(
            [QUESTIONS, COMMUNITIES],
            "select q.*, community from questions q left join communities using (question_id)",
        ),
        "join_explanation_means": _query(
            [*_CONTENTS, QUESTIONS],
            """select question_id as content_id, bundle_id, content_explation_false_mean,
            content_explation_true_mean
            from questions left join contents on question_id = content_id""",
        ),
        "holdout_user_rows": _query(
            _ANSWERED, f"select row_id, user_id from answered where {NEW_USER}"
        ),
        "drop_rows_anti": _query(
            _ANSWERED, f"select row_id, user_id from answered where not ({HELD_OUT})"
        ),
        "join_questions": _query(
            [*_ANSWERED, QUESTIONS],
            """select row_id, user_id, content_id, bundle_id, part, tags
            from answered left join questions on content_id = question_id""",
        ),
        "user_lecture_profile": _query(
            [INTERACTIONS, LECTURES],
            f"select user_id, {_EVER} from {lectures_join} "
            "where content_type_id = 1 group by user_id",
        ),
        "user_lecture_totals": _query(
            _LOG,
            """select user_id, cast(sum(content_type_id) as bigint) as sum, count(*) as count
            from interactions group by user_id""",
        ),
        "content_explanation_pivot": _query(
            _CONTENTS,
            """select content_id, content_explation_false_mean, content_explation_true_mean
            from contents""",
        ),
        "attempt_totals": _query(
            _ANSWERED,
            "select user_id, content_id, count(*) as sum from answered group by all",
        ),
        "user_last_ts": _query(
            _ANSWERED,
            "select user_id, max(timestamp) as max_time_stamp from answered group by user_id",
        ),
        "user_prev_ts": _query(
            _ANSWERED,
            """select user_id, max(t2) as max_time_stamp2, max(t3) as max_time_stamp3
            from (select user_id, lag(timestamp, 1) over w as t2, lag(timestamp, 2) over w as t3
                  from answered window w as (partition by user_id order by row_id))
            group by user_id""",
        ),
        "user_last_elapsed": _query(
            _FILLED,
            """select user_id, round(prior_question_elapsed_time, 6)
            as prior_question_elapsed_time from elapsed_filled
            qualify row_number() over (partition by user_id order by row_id desc) = 1""",
        ),
        "user_explanation_totals": _query(
            _ANSWERED,
            """select user_id, cast(sum(prior_question_had_explanation) as bigint) as sum,
            count(*) as count from answered group by user_id""",
        ),
        "task_container_stats": _query([*_ANSWERED, CONTAINERS], "select * from containers"),
        "bundle_size": _query(
            [QUESTIONS],
            """select question_id, bundle_id,
            count(*) over (partition by bundle_id) as content_sub_bundle from questions""",
        ),
        "content_stats": _query(
            _CONTENTS,
            """select content_id, content_correctness,
            round(content_correctness_std, 6) as content_correctness_std,
            content_uncorrect_count, content_correct_count from contents""",
        ),
        "content_elapsed_mean": _query(
            _CONTENTS,
            """select content_id, round(content_elapsed_time_mean, 6)
            as content_elapsed_time_mean from contents""",
        ),
        "content_explanation_mean": _query(
            _CONTENTS, "select content_id, content_had_explanation_mean from contents"
        ),
        "part_correctness": _query(
            _STATS,
            """select part, round(part_correctness_mean, 6) as part_correctness_mean,
            round(part_correctness_std, 6) as part_correctness_std from parts""",
        ),
        "part_counts": _query(_STATS, "select part, part_uncor_count, part_cor_count from parts"),
        "bundle_correctness": _query(
            _STATS,
            """select bundle_id, round(bundle_correctness_mean, 6) as bundle_correctness_mean
            from bundles""",
        ),
        "global_means": _query(
            _LAGGED,
            """select
            (select round(avg(prior_question_elapsed_time), 4) from answered) as elapsed_mean,
            round(avg(g1), 4) as lagtime_mean, round(avg(g2), 4) as lagtime2_mean,
            round(avg(g3), 4) as lagtime3_mean, round(avg(d), 4) as delta_mean from gaps""",
        ),
        "distinct_users": _query(_ANSWERED, "select distinct user_id from answered"),
        "split_counts": _query(
            [*_ANSWERED, FOLDS],
            """select fold, case when valid_kind is null then 'train' else 'valid' end as split,
            count(*) as rows from folds group by all""",
        ),
        "roc_auc": _query(
            [*_ANSWERED, PRIOR],
            """select round((sum(r) filter (answered_correctly = 1) - p * (p + 1) / 2)
              / (p * n), 9) as auc
            from (select answered_correctly,
                    rank() over (order by user_correctness)
                      + (count(*) over (partition by user_correctness) - 1) / 2 as r,
                    cast(sum(answered_correctly) over () as double) as p,
                    cast(sum(1 - answered_correctly) over () as double) as n
                  from prior)
            group by p, n""",
        ),
        "user_interaction_count": _query(
            [*_LOG, COUNTED], "select row_id, user_interaction_count from counted"
        ),
        "user_interaction_ts_mean": _query(
            [*_LOG, COUNTED], "select row_id, user_interaction_timestamp_mean from counted"
        ),
        "user_lecture_sum": _query(
            [*_LOG, COUNTED], "select row_id, user_lecture_sum from counted"
        ),
        "user_lecture_lv": _query([*_LOG, COUNTED], "select row_id, user_lecture_lv from counted"),
        "attempt_no": _query([*_ANSWERED, ATTEMPTS], "select * from attempts"),
        "lagtime": _query(_LAGGED, "select row_id, round(lagtime, 8) as lagtime from lagged"),
        "lagtime2": _query(_LAGGED, "select row_id, round(lagtime2, 8) as lagtime2 from lagged"),
        "lagtime3": _query(_LAGGED, "select row_id, round(lagtime3, 8) as lagtime3 from lagged"),
        "delta_elapsed": _query(
            _LAGGED, "select row_id, delta_prior_question_elapsed_time from lagged"
        ),
        "user_prior_accuracy": _query(
            [*_ANSWERED, PRIOR],
            """select row_id, user_id, user_correct_count, user_uncorrect_count,
            user_correctness from prior""",
        ),
        "explanation_running": _query([*_ANSWERED, EXPLAINED], "select * from explained"),
        "tag_bands": _query([QUESTIONS, TAGS], "select * from bands"),
        "label_encode": _query([QUESTIONS, TAGS, CODES], "select * from codes"),
        "safe_ratio": _query(
            _ANSWERED,
            """select user_id, (count(*) - sum(prior_question_had_explanation))
            / nullif(sum(prior_question_had_explanation), 0) as ratio
            from answered group by user_id""",
        ),
        "valid_union": _query(
            _ANSWERED,
            f"select row_id, user_id, {KIND} as valid_kind from answered "
            f"where {NEW_USER} or {HELD_OUT}",
        ),
        "sample_n": _query(
            _ANSWERED,
            f"select row_id, user_id from answered order by {draw('rows', 'row_id')}, row_id "
            f"limit {SAMPLE_ROWS}",
        ),
        "sample_users": _query(
            _ANSWERED, f"select distinct user_id from answered where {NEW_USER}"
        ),
        "sample_rows": _query(
            _ANSWERED, f"select row_id, user_id from answered where {HELD_OUT}"
        ),
        "holdout_split": _query(
            [*_ANSWERED, QUESTIONS],
            f"""select row_id, user_id, content_id, part,
            case when {NEW_USER} or {HELD_OUT} then 'valid' else 'train' end as split,
            {KIND} as valid_kind
            from answered left join questions on content_id = question_id
            order by {draw('rows', 'row_id')}, row_id limit 12000000""",
        ),
        "gbt_stump": _query(
            [*_ANSWERED, QUESTIONS],
            f""",marked as (
              select row_id, answered_correctly, coalesce(cast(part as double), -1) as part,
                {NEW_USER} or {HELD_OUT} as valid
              from answered left join questions on content_id = question_id),
            sums as (
              select part, count(*) as n, sum(2 * answered_correctly - 1) as s
              from marked where not valid group by part),
            cuts as (
              select (part + lead(part) over parts) / 2 as cut,
                sum(n) over parts as n1, sum(s) over parts as s1,
                sum(n) over () as n, sum(s) over () as s
              from sums window parts as (order by part)),
            best as (
              select cut, s1 / n1 as low, (s - s1) / (n - n1) as high from cuts
              where cut is not null order by s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) desc, cut
              limit 1)
            select row_id, answered_correctly,
              round(1 / (1 + exp(-2 * case when part <= cut then low else high end)), 6) as score
            from marked, best where valid""",
        ),
        "gbt_category_stump": _query(
            [*_ANSWERED, QUESTIONS],
            f""",marked as (
              select row_id, answered_correctly, {_PART} as part, {NEW_USER} or {HELD_OUT} as valid
              from answered left join questions on content_id = question_id),
            sums as (
              select part, count(*) as n, sum(2 * answered_correctly - 1) as s
              from marked where not valid group by part),
            cuts as (
              select list(part) over w as chosen, row_number() over w as place,
                count(*) over () as parts, sum(n) over w as n1, sum(s) over w as s1,
                sum(n) over () as n, sum(s) over () as s
              from sums window w as (order by s / n, part)),
            best as (
              select chosen, s1 / n1 as low, (s - s1) / (n - n1) as high from cuts
              where place < parts
              order by s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) desc, place limit 1)
            select row_id, answered_correctly, round(
              1 / (1 + exp(-2 * case when list_contains(chosen, part) then low else high end)), 6) as score
            from marked, best where valid""",
        ),
        "write_features": _query(
            [*_ANSWERED, FOLDS],
            """select row_id, answered_correctly, valid_kind, fold,
            case when valid_kind is null then 'train' else 'valid' end as split
            from folds join answered using (row_id)""",
        ),
        "gbt_rounds": _query(
            [*_ANSWERED, QUESTIONS, FOLDS],
            f""",counts as (
              select fold, {_PART} as part, valid_kind is not null as valid,
                sum(answered_correctly) as pos, sum(1 - answered_correctly) as neg
              from folds join answered using (row_id) left join questions on content_id = question_id
              group by all),
            {boosted_stumps(ROUNDS, STUMP_STEP)},{round_aucs(ROUNDS)}""",
        ),
        "gbt_reloaded": _query(
            [*_ANSWERED, QUESTIONS],
            f""",marked as (
              select row_id, answered_correctly, {_PART} as part, {NEW_USER} or {HELD_OUT} as valid
              from answered left join questions on content_id = question_id),
            counts as (
              select 0 as fold, part, valid, sum(answered_correctly) as pos,
                sum(1 - answered_correctly) as neg from marked group by all),
            {boosted_stumps(ROUNDS, STUMP_STEP)}
            select row_id, answered_correctly, round(1 / (1 + exp(-2 * f)), 6) as score
            from marked join m{ROUNDS} using (part) where valid""",
        ),
        "repeated_folds": _query(
            [*_ANSWERED, FOLDS],
            """select fold, row_id,
            case when valid_kind is null then 'train' else 'valid' end as split, valid_kind
            from folds""",
        ),
        "history_features": _query(_HISTORY, "select * from history"),
        "question_features": _query(_FEATURES, "select * from question_features"),
        "training_matrix": _training(FEATURES),
        "tuning_matrix": _training(FEATURES.replace("content_correctness,\n", "\n", 1)),
        "preprocess": _query(
            _MATRIX,
            """,inputs as (
              select row_id, h.prior_question_had_explanation as flag,
                cast(l.prior_question_elapsed_time as double) as a,
                cast(user_interaction_count as double) as b, user_correctness as c,
                content_correctness as d
              from history h join lagged l using (row_id)
              left join question_features q on h.content_id = q.content_id),
            filled as (
              select * replace (coalesce(d, (select avg(d) from inputs)) as d) from inputs)
            select row_id,
              round((a - (select avg(a) from filled)) / (select stddev_pop(a) from filled), 6)
                as scaled_prior_question_elapsed_time,
              round((b - (select avg(b) from filled)) / (select stddev_pop(b) from filled), 6)
                as scaled_user_interaction_count,
              round((c - (select avg(c) from filled)) / (select stddev_pop(c) from filled), 6)
                as scaled_user_correctness,
              round((d - (select avg(d) from filled)) / (select stddev_pop(d) from filled), 6)
                as scaled_content_correctness,
              cast(flag = 0 as int) as explained_0, cast(flag = 1 as int) as explained_1
            from filled""",
        ),
    }
