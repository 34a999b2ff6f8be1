"""Receiver metadata as tables.

The original provisioned the receiver with shell loops: look an object up,
create it if absent, append ids to lists, pick defaults by priority. Each loop
is a relational step here: anti join, union, per-row array union, and a
grouped ``min_by``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportflow.functions.expr import jtrim

# The token the metadata templates carry, and the user access lists.
FACILITY_LEVEL_TOKEN = "<OU_LEVEL_FACILITY_UID>"
USER_ACCESS_LISTS = ("organisationUnits", "dataViewOrganisationUnits", "teiSearchOrganisationUnits")


def insert_missing(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Insert-if-absent: (rows to create, resulting table). Existing rows are never changed.

    Incoming repeats of one key are created once (first by the remaining columns).
    """
    new = incoming.join(existing.select(*key), list(key), "left_anti")
    rest = [c for c in incoming.columns if c not in key]
    if rest:
        new = (new.groupBy(*key).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_r"))
               .select(*key, *[F.col("_r")[c].alias(c) for c in rest]))
    else:
        new = new.dropDuplicates(list(key))
    return new, existing.unionByName(new, allowMissingColumns=True)


def assign_all_members(members: DataFrame, user_ids: Sequence[str], id_col: str = "id",
                       lists: Sequence[str] = USER_ACCESS_LISTS) -> DataFrame:
    """Every member id on each access list of each named user (long form, replaces the lists).

    The users are a short configured list, so the member table is read once and
    each row opens into the users' lists; no two data tables are paired.
    """
    if not user_ids:
        raise ValueError("no user ids given")
    places = F.array(*[F.struct(F.lit(u).alias("user_id"), F.lit(x).alias("list_name")) for u in user_ids for x in lists])
    return members.select(F.col(id_col).alias("member_id"), F.explode(places).alias("_p")).select(
        "_p.user_id", "_p.list_name", "member_id")


def add_members(existing: Column, new: Column) -> Column:
    """Per-row: append the new ids that are not on the list yet.

    The existing list is kept exactly (order and any repeats already there);
    each new id is appended once, in the order given.
    """
    empty = F.array().cast("array<struct<id:string>>")
    ex = F.coalesce(existing, empty)
    # array_except keeps the first array's order and drops repeats: no lambda, codegen'd.
    return F.concat(ex, F.array_except(F.coalesce(new, empty), ex))


def add_members_long(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Membership in long form (set id, member id): add what is missing, drop repeats."""
    return (existing.select(*key).dropDuplicates(list(key))
            .unionByName(new.select(*key).join(existing.select(*key), list(key), "left_anti")
                         .dropDuplicates(list(key))))


def pick_by_priority(candidates: DataFrame, group_cols: Sequence[str], id_col: str,
                     priority: Column, groups: DataFrame | None = None,
                     fallback: str | None = None) -> DataFrame:
    """Per group, the candidate with the lowest priority, ties by id; else ``fallback``.

    ``min_by`` merges map-side, so a group with many candidates is never
    gathered in one task. ``groups`` lists every group that needs an answer.
    """
    picked = (candidates.groupBy(*group_cols)
              .agg(F.min_by(F.struct(F.col(id_col).alias("id"), priority.alias("priority")),
                            F.struct(priority, F.col(id_col))).alias("_p")))
    if groups is not None:
        picked = groups.select(*group_cols).join(picked, list(group_cols), "left")
    return picked.select(*group_cols,
                         F.coalesce(F.col("_p.id").cast("string"), F.lit(fallback)).alias("picked_id"),
                         F.col("_p.priority").alias("priority"))


def dataset_definition(elements: DataFrame, data_set_col: str, element_col: str,
                       combo: Column) -> DataFrame:
    """Nest a data set's element list: one ``{dataElement, categoryCombo}`` per element.

    An element list is configuration-sized (a form's fields), so it is
    collected per data set; repeats are kept once, sorted by element id.
    """
    leaf = F.struct(F.struct(F.col(element_col).cast("string").alias("id")).alias("dataElement"),
                    F.struct(combo.alias("id")).alias("categoryCombo"))
    return (elements.groupBy(data_set_col)
            .agg(F.array_sort(F.collect_set(leaf)).alias("dataSetElements")))


def fill_token(text: Column, value: Column | str, token: str = FACILITY_LEVEL_TOKEN) -> Column:
    """Replace every ``token`` in a template."""
    return F.replace(text, F.lit(token), value if isinstance(value, Column) else F.lit(value))


def split_spec(line: Column) -> list[Column]:
    """``id|name|description``; the last field keeps further pipes, missing fields are '' (X16)."""
    parts = F.split(line, r"\|", 3)
    return [F.coalesce(F.get(parts, i), F.lit("")).alias(n)
            for i, n in enumerate(("id", "name", "description"))]


def normalize_url(url: Column) -> Column:
    """Trim, drop one trailing slash, append ``/api`` unless it already ends so."""
    t = F.regexp_replace(jtrim(url), r"/\z", "")
    return F.when(t.endswith("/api"), t).otherwise(F.concat(t, F.lit("/api")))
