"""Identity vault, column masks by role and tag, row filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed formats of the masks: patterns and replacement texts.
EMAIL_USER, EMAIL_SHOWN = ".+@", "***@"
CARD_NUMBER, CARD_SHOWN = "[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}", "XXXX-XXXX-XXXX-XXXX"
SSN_SHOWN, PHONE_SHOWN, NAME_SHOWN, FULL = "XXX-XX-", "***-***-", "***", "*****"


def last_four(prefix: str = SSN_SHOWN) -> Callable[[Column], Column]:
    return lambda c: F.concat(F.lit(prefix), F.right(c, F.lit(4)))


def hide_email_user(c: Column) -> Column:
    return F.regexp_replace(c, EMAIL_USER, EMAIL_SHOWN)


def hide_cards(c: Column) -> Column:
    return F.regexp_replace(c, CARD_NUMBER, CARD_SHOWN)


MASKS: dict[str, Callable[[Column], Column]] = {
    "EMAIL": hide_email_user, "SSN": last_four(), "PHONE": last_four(PHONE_SHOWN), "CARD": hide_cards,
    "NAME": lambda c: F.concat(F.substring(c, 1, 1), F.lit(NAME_SHOWN)),
}


def mask(df: DataFrame, policy: Mapping[str, str], role: str, cleared: Sequence[str] = ("ADMIN",)) -> DataFrame:
    """Columns masked by kind unless the role is cleared; nulls stay null."""
    if role in cleared:
        return df
    return df.withColumns({c: MASKS[kind](F.col(c)) for c, kind in policy.items()})


def mask_by_level(
    df: DataFrame, policy: Mapping[str, str], role: str, cleared: Mapping[str, Sequence[str]], partial: Sequence[str] = ("ANALYST",)
) -> DataFrame:
    """Three levels for each column: cleared roles see it, ``partial`` roles see its mask, all others see nothing of it.

    ``cleared`` names the cleared roles of a column; ``"*"`` holds for columns it does not name. Nulls stay null.
    """

    def shown(column: str, kind: str) -> Column:
        value = F.col(column)
        if role in cleared.get(column, cleared.get("*", ())):
            return value
        return MASKS[kind](value) if role in partial else F.when(value.isNotNull(), F.lit(FULL))

    return df.withColumns({c: shown(c, kind) for c, kind in policy.items()})


def tag(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Stores a semantic tag in each column's metadata."""
    for column, value in tags.items():
        df = df.withMetadata(column, {**df.schema[column].metadata, "semantic": value})
    return df


def mask_tagged(df: DataFrame, role: str, cleared: Sequence[str] = ("ADMIN",)) -> DataFrame:
    """Applies the mask of each column's tag."""
    policy = {f.name: f.metadata["semantic"] for f in df.schema.fields if f.metadata.get("semantic") in MASKS}
    return mask(df, policy, role, cleared)


def split_identity(df: DataFrame, key: str, identity: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The identity columns for the vault and the rest for everyone, linked by a hashed key."""
    hashed = F.md5(F.col(key).cast("string")).alias("identity_key")
    vault = df.select(hashed, key, *identity)
    public = df.select(hashed, *[c for c in df.columns if c != key and c not in identity])
    return vault, public


def restrict_rows(df: DataFrame, assignments: DataFrame, user: str, on: str) -> DataFrame:
    """Rows whose ``on`` value is assigned to the user."""
    mine = assignments.where(F.col("user") == user).select(on).distinct()
    return df.join(mine, on, "left_semi")


def restrict_rows_by_any(
    df: DataFrame, assignments: Mapping[str, DataFrame], user: str, role: str, cleared: Sequence[str] = ("ADMIN",)
) -> DataFrame:
    """Rows of which any attribute is assigned to the user; a cleared role sees every row.

    ``assignments`` maps a column of ``df`` to its frame (user, column). Each is reduced to one row per value first, so
    that a row meets at most one of it.
    """
    if role in cleared:
        return df
    hit, out = F.lit(False), df
    for n, (column, frame) in enumerate(assignments.items()):
        mine = frame.where(F.col("user") == user).select(F.col(column).alias(f"_mine_{n}")).distinct()
        out = out.join(mine, F.col(column) == F.col(f"_mine_{n}"), "left")
        hit = hit | F.col(f"_mine_{n}").isNotNull()
    return out.where(hit).select(*df.columns)
