"""Raw rows to typed staging rows.

Strict staging fails on the first unreadable or over-long value, as a load into the typed
tables would. ``enforce_lengths=False`` lets long text pass. ``problems`` lists the
offending columns instead, for the rejects table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.functions.parsing import parse_amount, parse_day, parse_listed_day, unread
from cardwarden.schemas import Table
from cardwarden.sources.delimited import MALFORMED

_PARSED = {"trans_date": parse_day, "amt": parse_amount, "entry_dt": parse_listed_day}


def conform(df: DataFrame, table: Table, enforce_lengths: bool = True) -> DataFrame:
    """Columns picked by name in the table's order and given its types."""
    typed = {field.name: F.col(field.name).cast(field.dataType) for field in table.schema}
    return df.select(*_limited(typed, table, enforce_lengths))


def stage_transactions(
    raw: DataFrame,
    *carried: Column,
    enforce_lengths: bool = True,
    trim_cards: bool = False,
) -> DataFrame:
    """Typed transactions, followed by any further columns asked for.

    Card numbers are taken as they come, so a padded one finds no card. ``trim_cards``
    makes it find its card.
    """
    typed = _parsed(schemas.TRANSACTIONS)
    if trim_cards:
        typed["card_num"] = F.trim(typed["card_num"])
    return raw.select(*_limited(typed, schemas.TRANSACTIONS, enforce_lengths), *carried)


def stage_blacklist(
    raw: DataFrame, *carried: Column, enforce_lengths: bool = True
) -> DataFrame:
    """Typed blacklist entries, followed by any further columns asked for."""
    typed = _parsed(schemas.BLACKLIST)
    return raw.select(*_limited(typed, schemas.BLACKLIST, enforce_lengths), *carried)


def stage_terminals(raw: DataFrame, run_dt: date, enforce_lengths: bool = True) -> DataFrame:
    """Terminal sheets carry no dates: a new terminal is dated with the run."""
    stamped = raw.withColumns({"create_dt": F.lit(run_dt), "update_dt": F.lit(None)})
    return conform(stamped, schemas.TERMINALS, enforce_lengths)


def stage_clients(pulled: DataFrame, enforce_lengths: bool = True) -> DataFrame:
    return conform(pulled, schemas.CLIENTS, enforce_lengths)


def stage_accounts(pulled: DataFrame, enforce_lengths: bool = True) -> DataFrame:
    renamed = pulled.withColumnRenamed("account", "account_num")
    return conform(renamed, schemas.ACCOUNTS, enforce_lengths)


def stage_cards(pulled: DataFrame, enforce_lengths: bool = True) -> DataFrame:
    """The bank pads card numbers with spaces; transactions carry them bare."""
    renamed = pulled.withColumnRenamed("account", "account_num")
    bare = renamed.withColumn("card_num", F.trim("card_num"))
    return conform(bare, schemas.CARDS, enforce_lengths)


def problems(raw: DataFrame, table: Table) -> Column:
    """Names of the columns strict staging would fail on, comma-separated; empty if none."""
    found = []
    if MALFORMED in raw.columns:
        found.append(F.when(F.col(MALFORMED).isNotNull(), F.lit(MALFORMED)))
    for name in (n for n in table.columns if n in raw.columns):
        if name in _PARSED:
            found.append(F.when(unread(F.col(name), _PARSED[name](F.col(name))), F.lit(name)))
        elif name in table.limits:
            found.append(F.when(too_long(F.col(name), table.limits[name]), F.lit(name)))
    return F.concat_ws(",", *found)


def rejects(raw: DataFrame, table: Table) -> DataFrame:
    """Raw rows that strict staging refuses, with the reason."""
    return raw.withColumn("problems", problems(raw, table)).where(F.col("problems") != "")


def accepted(raw: DataFrame, table: Table) -> DataFrame:
    """The remaining raw rows: rejects and accepted rows add up to the input."""
    return raw.where(problems(raw, table) == "")


def too_long(text: Column, limit: int) -> Column:
    """Over-long text; trailing spaces beyond the limit do not count."""
    return F.length(F.rtrim(text)) > limit


def _parsed(table: Table) -> dict[str, Column]:
    """Values read from text; text that cannot be read fails the query when it runs."""
    typed = {}
    for name in table.columns:
        text = typed[name] = F.col(name)
        if name in _PARSED:
            value = _PARSED[name](text)
            complaint = F.concat(F.lit(f"unreadable {name}: "), text)
            failed = F.when(unread(text, value), F.raise_error(complaint))
            typed[name] = failed.otherwise(value)
    return typed


def _limited(typed: dict[str, Column], table: Table, enforce_lengths: bool) -> list[Column]:
    """The columns in table order; text over its limit fails the query when it runs.

    Spaces beyond the limit are cut off, as they are on a load into a limited text column.
    """
    columns = []
    for name, value in typed.items():
        limit = table.limits.get(name)
        if enforce_lengths and limit is not None:
            complaint = F.concat(F.lit(f"{name} is longer than {limit}: "), value)
            cut = F.when(F.length(value) > limit, F.substring(value, 1, limit)).otherwise(value)
            value = F.when(too_long(value, limit), F.raise_error(complaint)).otherwise(cut)
        columns.append(value.alias(name))
    return columns
