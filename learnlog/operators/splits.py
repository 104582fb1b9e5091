"""Deterministic samples and repeated train / validation splits.

A row's draw is a hash of a seed and its id. Membership in a fraction is then a
predicate on the row itself: no shuffle, the same rows after a retry, and the
remainder is its negation. Fractions are hit in expectation, a fixed number of
rows exactly.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlog.functions.columns import draw, drawn
from learnlog.operators.ordered import window

SAMPLE_ROWS = 12_000_000
USER_SHARE = 0.08
ROW_SHARE = 0.1
FOLDS = 5
DIGITS = 3  # hex digits of a draw that are counted at a time: 16 ** 3 counters
MOST_RANKED = 100_000  # rows of a prefix that are ranked, not counted again


def row_draw(seed: int | str, id_col: str = "row_id") -> str:
    return draw("rows", id_col, seed)


def user_draw(seed: int | str) -> str:
    return draw("users", "user_id", seed)


def holdout_draw(seed: int | str, id_col: str = "row_id") -> str:
    return draw("holdout", id_col, seed)


# --- exact samples --------------------------------------------------------------


def _by_group(values: Mapping[tuple, Column], within: Sequence[str]) -> Column:
    """The value of a row's group, NULL for other groups."""
    found = F.lit(None)
    for group, value in values.items():
        same = F.lit(True)
        for name, part in zip(within, group):
            same &= F.col(name) == part
        found = F.when(same, value).otherwise(found)
    return found


def _inside(heads: Mapping[tuple, str], within: Sequence[str]) -> Column:
    """Rows whose draw begins with the prefix that their group looks into.

    The draw is named once: a filter works it out for every mention of it.
    """
    digits = len(next(iter(heads.values()), ""))
    head = _by_group({group: F.lit(head) for group, head in heads.items()}, within)
    return F.substring("draw", 1, digits) == head


def _cuts(drawn_rows: DataFrame, n: int, within: Sequence[str]) -> dict[tuple, tuple]:
    """Per group of more than ``n`` rows, the n-th by (draw, id) as (draw, id).

    A radix select: one pass counts rows per prefix of ``DIGITS`` hex digits, which tells
    whether a group is cut at all and in which prefix. Only rows of that prefix are looked at
    again; they are counted by as many more digits while there are too many to rank. At
    most 16 ** DIGITS counters of a group reach the driver at a time.
    """
    taken: dict[tuple, int] = {}
    heads: dict[tuple, str] = {}
    rows, digits, size = drawn_rows, 0, 0
    while not digits or (heads and size > MOST_RANKED and digits < 32):
        digits += DIGITS
        head = F.substring("draw", 1, digits).alias("head")
        counts: dict[tuple, list] = {}
        for row in rows.groupBy(*within, head).agg(F.count("*").alias("rows")).collect():
            counts.setdefault(tuple(row[k] for k in within), []).append((row["head"], row["rows"]))
        heads, size = {}, 0
        for group, found in counts.items():
            before = taken.get(group, 0)
            if digits == DIGITS and sum(count for _, count in found) <= n:
                continue
            for prefix, count in sorted(found):
                if before + count >= n:
                    heads[group], taken[group] = prefix, before
                    size = max(size, count)
                    break
                before += count
        rows = drawn_rows.where(_inside(heads, within))
    if not heads:
        return {}
    rank = f"row_number() over {window([*within, 'head'], 'draw, id')} as rank"
    ranked = rows.selectExpr("*", f"substring(draw, 1, {digits}) as head").selectExpr("*", rank)
    last = _by_group({g: F.lit(n - taken[g]) for g in heads}, within)
    found = ranked.where(F.col("rank") == last).collect()
    return {tuple(r[k] for k in within): (r["draw"], r["id"]) for r in found}


def _kept(drawn_rows: DataFrame, cuts: Mapping[tuple, tuple], within: Sequence[str], id_col: str) -> DataFrame:
    """Rows with ``draw`` that are not after the cut of their group, if it has one."""
    last = {g: F.struct(F.lit(draw_).alias("draw"), F.lit(id_).alias("id")) for g, (draw_, id_) in cuts.items()}
    here = F.struct(F.col("draw"), F.col(id_col).alias("id"))
    return drawn_rows.where(F.coalesce(here <= _by_group(last, within), F.lit(True))).drop("draw")


def sample_n(
    df: DataFrame, n: int, seed: int, id_col: str = "row_id", ids: DataFrame | None = None
) -> DataFrame:
    """Exactly ``n`` rows without replacement; all rows if there are fewer.

    The rows are the first ``n`` by (draw, id), found by a threshold: the data is
    filtered in place, neither sorted nor sent through one task. The threshold comes
    from ``ids``, the same ids in a frame that is cheaper to read, where it is given:
    ``df`` is then computed once, for the filter.
    """
    if n <= 0:
        return df.where("false")
    drawn_rows = (df if ids is None else ids).selectExpr(
        f"{row_draw(seed, id_col)} as draw", f"{id_col} as id"
    )
    cuts = _cuts(drawn_rows, n, [])
    if not cuts:
        return df
    return _kept(df.selectExpr("*", f"{row_draw(seed, id_col)} as draw"), cuts, [], id_col)


# --- fractions ------------------------------------------------------------------


def distinct_users(df: DataFrame) -> DataFrame:
    return df.select("user_id").distinct()


def sample_users(df: DataFrame, share: float, seed: int) -> DataFrame:
    """A share of the distinct users."""
    return df.where(drawn(user_draw(seed), share)).select("user_id").distinct()


def sample_rows(df: DataFrame, share: float, seed: int, id_col: str = "row_id") -> DataFrame:
    """A share of the rows."""
    return df.where(drawn(holdout_draw(seed, id_col), share))


# --- row identity ----------------------------------------------------------------


def rows_of_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows whose user is listed. The list has no size bound, so no broadcast is forced."""
    return df.join(users.select("user_id"), "user_id", "left_semi")


def drop_rows(df: DataFrame, rows: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Rows that are not in ``rows``, by row identity."""
    return df.join(rows.select(id_col), id_col, "left_anti")


def valid_union(random_rows: DataFrame, new_user_rows: DataFrame) -> DataFrame:
    """Both kinds of validation rows, marked by ``valid_kind``."""
    return random_rows.withColumn("valid_kind", F.lit("random")).unionByName(
        new_user_rows.withColumn("valid_kind", F.lit("new_user"))
    )


# --- splits ----------------------------------------------------------------------


def mark_holdout(
    df: DataFrame,
    seed: int | str,
    user_share: float = USER_SHARE,
    row_share: float = ROW_SHARE,
    id_col: str = "row_id",
) -> DataFrame:
    """All rows with ``split`` and ``valid_kind`` as in :func:`holdout_split`, no sample."""
    kind = (
        f"case when {drawn(user_draw(seed), user_share)} then 'new_user' "
        f"when {drawn(holdout_draw(seed, id_col), row_share)} then 'random' end as valid_kind"
    )
    return df.selectExpr("*", kind).selectExpr(
        "*", "case when valid_kind is null then 'train' else 'valid' end as split"
    )


def holdout_split(
    df: DataFrame,
    seed: int,
    n: int = SAMPLE_ROWS,
    user_share: float = USER_SHARE,
    row_share: float = ROW_SHARE,
    id_col: str = "row_id",
    ids: DataFrame | None = None,
) -> DataFrame:
    """A sample of ``n`` rows with ``split`` (train, valid) and ``valid_kind``.

    A share of the users is held out whole (``new_user``), then a share of the
    remaining rows (``random``). One pass: a user's and a row's draw decide it.
    """
    sample = sample_n(df, n, seed, id_col, ids)
    return mark_holdout(sample, seed, user_share, row_share, id_col)


def repeated_folds(
    df: DataFrame,
    seed: int,
    folds: int = FOLDS,
    n: int = SAMPLE_ROWS,
    user_share: float = USER_SHARE,
    row_share: float = ROW_SHARE,
    id_col: str = "row_id",
    ids: DataFrame | None = None,
) -> DataFrame:
    """Independent splits, numbered by ``fold``; fold ``i`` is the split of ``seed + i``.

    All folds come from one scan: each row is offered to every fold and kept
    where it is not after that fold's cut. ``ids`` is as in :func:`sample_n`.
    """
    if folds < 1:
        raise ValueError("folds must be positive")
    fold = f"explode(sequence(0, {folds - 1})) as fold"
    fold_seed = f"(fold + {seed})"
    drawn_rows = (df if ids is None else ids).selectExpr(f"{id_col} as id", fold).selectExpr(
        "fold", "id", f"{row_draw(fold_seed, 'id')} as draw"
    )
    if n <= 0:
        return mark_holdout(df.where("false").selectExpr("*", fold), fold_seed, user_share, row_share, id_col)
    offered = df.selectExpr("*", fold)
    cuts = _cuts(drawn_rows, n, ["fold"])
    sampled = offered
    if cuts:
        drawn_again = offered.selectExpr("*", f"{row_draw(fold_seed, id_col)} as draw")
        sampled = _kept(drawn_again, cuts, ["fold"], id_col)
    return mark_holdout(sampled, fold_seed, user_share, row_share, id_col)


def split_counts(folds: DataFrame) -> DataFrame:
    return folds.groupBy("fold", "split").agg(F.count("*").alias("rows"))
