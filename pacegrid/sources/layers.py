"""Loads into the bronze and silver tables of a store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pacegrid import schema as declared
from pacegrid.operators.dedupe import dedupe_on
from pacegrid.sources.files import conform
from pacegrid.sources.store import Load
from pacegrid.sources.tables import LOAD_RULES, bronze_schema, stamped


def load_layers(load: Load, batch: DataFrame, table: str, written: bool = False) -> None:
    """Bring a batch into bronze, as it is and first version only, and into silver.

    Silver has the declared columns, one row per primary key, and the table's load rule;
    rows without a key stay in bronze. A batch that is not ``written`` aside yet is read once:
    the first one goes into bronze whole and is read from there, later ones are written aside.
    """
    rule, key = LOAD_RULES[table]
    first = not load.holds(f"bronze/{table}")
    if not (first or written):
        batch = load.staged(batch)
    load.insert_only(f"bronze/{table}", stamped(conform(batch, bronze_schema(table))), key, written=True)
    if first:
        batch = load.read(f"bronze/{table}")
    pk = declared.PRIMARY_KEY[table]
    placed = conform(batch, declared.SILVER[table]).dropna(subset=list(dict.fromkeys([*pk, key])))
    silver = dedupe_on(placed, pk)
    if rule == "insert_only":
        load.insert_only(f"silver/{table}", silver, key)
    else:
        load.upsert(f"silver/{table}", silver, key)
