"""SQL expressions shared by the operators. All are built-in, none is a UDF.

Each function takes and returns the text of an expression: one text is one call
into the JVM, however many functions it combines.
"""

from learnlog import schemas


def hours(ms: str) -> str:
    return f"(({ms}) / {schemas.MS_PER_HOUR})"


def ratio(numerator: str, denominator: str) -> str:
    """Division that is NULL, not an error, where the denominator is zero."""
    return f"try_divide(cast({numerator} as double), cast({denominator} as double))"


def had_explanation(column: str = "prior_question_had_explanation") -> str:
    """The explanation flag as 0/1, missing counted as not seen."""
    return f"coalesce(cast({column} as int), 0)"


def is_answered() -> str:
    return f"{schemas.TARGET} <> {schemas.NOT_APPLICABLE}"


def is_lecture() -> str:
    return "content_type_id = 1"


def part_bundle_key(part: str = "part", bundle_id: str = "bundle_id") -> str:
    return f"(cast({part} as bigint) * 100000 + cast({bundle_id} as bigint))"


def filled_tags(tags: str = "tags") -> str:
    return f"coalesce({tags}, '{schemas.MISSING_TAGS}')"


def tag_band(tags: str, band: int) -> str:
    """Tags of one band of 32, in their order, duplicates kept, ``''`` if none."""
    low = band * schemas.TAG_BAND_WIDTH
    high = low + schemas.TAG_BAND_WIDTH - 1
    inside = f"filter(split({tags}, ' '), t -> cast(t as int) between {low} and {high})"
    return f"array_join({inside}, ' ')"


def lecture_type(column: str = "type_of") -> str:
    return f"case when {column} = 'solving question' then 'solving_question' else {column} end"


def draw(kind: str, key: str, seed: int | str) -> str:
    """A pseudo-random hex string that depends only on the kind, seed and key."""
    return f"md5(concat_ws(':', cast({seed} as string), '{kind}', cast({key} as string)))"


def drawn(hashed: str, share: float) -> str:
    """True for about ``share`` of the draws: the leading 32 bits are below it."""
    bound = min(int(round(share * 2**32)), 2**32)
    if bound == 2**32:
        return "true"
    return f"(substring({hashed}, 1, 8) < '{bound:08x}')"
