"""Plain-Python versions of the operators, row by row, for small logs."""

from statistics import mean


def _avg(values):
    known = [v for v in values if v is not None]
    return mean(known) if known else None


def _fill(value, default):
    return default if value is None else value


def _users(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: r["row_id"]):
        groups.setdefault(row["user_id"], []).append(row)
    return groups


def history(log):
    """Dictionary row_id -> features; elapsed mean, fill, lag, delta mean, fill, in order."""
    rows = [dict(r) for r in log]
    for user_rows in _users(rows).values():
        lectures = 0
        for i, r in enumerate(user_rows, 1):
            lectures += r["content_type_id"]
            r["user_interaction_count"] = i
            r["user_interaction_timestamp_mean"] = r["timestamp"] / i / 3600000
            r["user_lecture_sum"] = lectures
            r["user_lecture_lv"] = lectures / i
            r["prior_question_had_explanation"] = int(bool(r["prior_question_had_explanation"]))
    rows = [r for r in rows if r["answered_correctly"] != -1]
    elapsed_mean = _avg([r["prior_question_elapsed_time"] for r in rows])
    for r in rows:
        r["prior_question_elapsed_time"] = _fill(r["prior_question_elapsed_time"], elapsed_mean)
    for user_rows in _users(rows).values():
        correct = explained = 0
        attempts = {}
        for i, r in enumerate(user_rows):
            for k, name in ((1, "lagtime"), (2, "lagtime2"), (3, "lagtime3")):
                gap = r["timestamp"] - user_rows[i - k]["timestamp"] if i >= k else None
                r[name] = gap
            previous = user_rows[i - 1]["prior_question_elapsed_time"] if i else None
            elapsed = r["prior_question_elapsed_time"]
            r["delta"] = None if previous is None else elapsed - previous
            r["user_correct_count"] = correct
            r["user_uncorrect_count"] = i - correct
            r["user_correctness"] = correct / i if i else 0.67
            correct += r["answered_correctly"]
            explained += r["prior_question_had_explanation"]
            r["explanation_true_count"] = explained
            r["explanation_false_count"] = i + 1 - explained
            r["explanation_mean"] = explained / (i + 1)
            attempts[r["content_id"]] = attempts.get(r["content_id"], 0) + 1
            r["attempt_no"] = attempts[r["content_id"]]
    means = {n: _avg([r[n] for r in rows]) for n in ("lagtime", "lagtime2", "lagtime3", "delta")}
    for r in rows:
        for name in ("lagtime", "lagtime2", "lagtime3"):
            gap = _fill(r[name], means[name])
            r[name] = None if gap is None else gap / 3600000
        delta = _fill(r.pop("delta"), means["delta"])
        r["delta_prior_question_elapsed_time"] = None if delta is None else int(delta)
        r["timestamp"] /= 3600000
    return {r["row_id"]: r for r in rows}


def auc(scores):
    """Share of (positive, negative) pairs ranked right, ties half."""
    positive = [s for s, y in scores if y == 1]
    negative = [s for s, y in scores if y == 0]
    if not positive or not negative:
        return None
    wins = sum((p > n) + (p == n) / 2 for p in positive for n in negative)
    return wins / (len(positive) * len(negative))
