"""Small logs with the edge cases, and a random one."""

import random

from pyspark.sql import types as T

from learnlog import schemas

SCHEMA = T.StructType(
    [schemas.INTERACTION_FILE[name] for name in schemas.INTERACTION_COLUMNS]
)


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in SCHEMA.names) for r in rows], SCHEMA)


def row(row_id, user_id, timestamp, content_id, answer, elapsed=None, explained=None, box=0):
    """``answer`` is 1, 0, or None for a lecture."""
    return {
        "row_id": row_id,
        "timestamp": timestamp,
        "user_id": user_id,
        "content_id": content_id,
        "content_type_id": int(answer is None),
        "task_container_id": box,
        "answered_correctly": -1 if answer is None else answer,
        "prior_question_elapsed_time": elapsed,
        "prior_question_had_explanation": explained,
    }


def edge_cases():
    return [
        row(0, 1, 0, 10, 1),  # one row
        row(1, 2, 0, 10, 0),  # two rows
        row(2, 2, 5000, 11, 1, 1200.5, True),
        row(3, 3, 0, 90, None),  # lecture first
        row(4, 3, 1000, 10, 1, None, False),
        row(5, 3, 1000, 10, 0, 2000.0, True),  # equal timestamp, repeated content
        row(6, 3, 9000, 91, None, 1.0, True),  # lecture between questions
        row(7, 3, 12000, 12, 1, 900.0, None),
        row(8, 4, 0, 90, None),  # lectures only
        row(9, 4, 10, 91, None),
        row(10, 5, 0, 13, 0, 100.0, True),  # content seen only with an explanation
        row(11, 5, 20, 14, 0, 700.25, False, 3),  # content and container seen once
        row(12, 5, 50, 10, 1, 40.0, False),
        row(13, 5, 90, 10, 1, None, True),
    ]


def random_log(n=600, users=7, seed=1):
    """One user holds a third of the rows; some runs are lectures only."""
    rng = random.Random(seed)
    clock, rows = {}, []
    for i in range(n):
        user = 0 if rng.random() < 0.34 else rng.randrange(1, users)
        clock[user] = clock.get(user, -7) + rng.randrange(0, 90000)
        lecture = rng.random() < 0.2 or (user == 0 and 100 < i < 160)
        rows.append(
            row(
                i * 3 + rng.randrange(3),  # gaps in row_id
                user,
                clock[user],
                rng.randrange(6),
                None if lecture else rng.randrange(2),
                rng.choice([None, round(rng.uniform(0, 9e4), 2)]),
                rng.choice([None, True, False]),
                rng.randrange(3),
            )
        )
    return rows
