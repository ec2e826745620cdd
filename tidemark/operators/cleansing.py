"""The cleansing rule list: each rule is a function from DataFrame to DataFrame.

All columns of one rule entry are added with one ``withColumns``, so the plan of a
rule list is a chain of projections that Catalyst collapses, plus lookup joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cleansing as c
from tidemark.operators.lookups import checked_all, lookup


def _each(columns: Sequence[dict], clean) -> dict[str, Column]:
    return {spec["tgt_col"]: clean(F.col(spec["src_col"])) for spec in columns}


def ascii_rule(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    return df.withColumns({s["src_col"]: c.ascii_only(F.col(s["src_col"])) for s in columns})


def timestamp_rule(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({n: c.timestamp_text(F.col(n)) for n in columns})


def timestamp_date_rule(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({n: c.timestamp_date(F.col(n)) for n in columns})


def date_rule(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    return df.withColumns(_each(columns, c.date_text))


def telephone_rule(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    return df.withColumns(_each(columns, c.telephone))


def tax_id_rule(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    hashes = {f"{s['tgt_col']}_hash": c.tax_id_hash(F.col(s["src_col"])) for s in columns}
    return df.withColumns({**hashes, **_each(columns, c.tax_id)})


_ADDRESS = {
    "address_line_1": c.address_line,
    "address_line_2": c.address_line,
    "city": c.city,
    "zipcode5": c.zip_code,
    "zipcode4": c.zip_code,
}


def address_rule(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    """Columns with another action are left alone."""
    return df.withColumns(
        {s["tgt_col"]: _ADDRESS[s["action"]](F.col(s["src_col"])) for s in columns if s["action"] in _ADDRESS}
    )


_NAME_PARTS = {"first_name": c.first_name, "middle_name": c.middle_name, "last_name": c.last_name}


def name_rule(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    added: dict[str, Column] = {}
    for spec in columns:
        action, src, tgt = spec["action"], spec["src_col"], spec["tgt_col"]
        if action == "full_name":
            parts = [F.col(n) for n in src[:4]]
            added[tgt] = c.full_name(*parts)
            added["flag_valid_fullname"] = c.full_name_flag(parts[0], parts[2])
        elif action in _NAME_PARTS:
            added[tgt] = _NAME_PARTS[action](F.col(src))
            added[f"flag_valid_{src}"] = c.present_flag(F.col(src))
        elif action == "suffix":
            added[tgt] = c.name_suffix(F.col(src))
    return df.withColumns(added)


def trim_rule(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    """The trimmed value takes the source name; the value as it was goes to the target name."""
    added: dict[str, Column] = {}
    for spec in columns:
        added[spec["tgt_col"]] = F.col(spec["src_col"])
        added[spec["src_col"]] = F.trim(F.col(spec["src_col"]))
    return df.withColumns(added)


def rtrim_rule(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    return df.withColumns({s["src_col"]: F.rtrim(F.col(s["src_col"])) for s in columns})


# Rules that need no code list.
RULES = {
    "ascii_only": ascii_rule,
    "timestamp": timestamp_rule,
    "timestamp_date": timestamp_date_rule,
    "date": date_rule,
    "dob": date_rule,
    "telephone": telephone_rule,
    "taxid": tax_id_rule,
    "address": address_rule,
    "name": name_rule,
    "trim_whitespace": trim_rule,
    "rtrim": rtrim_rule,
}

# Rules that join a code list: which of its columns is taken, and the value for no match.
LOOKUP_RULES: dict[str, tuple[str, str | None]] = {
    "gender": ("text", None),
    "marital_status": ("text", "N/A"),
    "state": ("value", None),
    "country": ("text", None),
}


def apply_rules(df: DataFrame, rules: Sequence[dict], lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Applies the rules in order. ``lookups`` maps a lookup rule's name to its code list."""
    # Rules can share a list; all lists are measured in one job.
    wanted = {id(codes): codes for entry in rules if (codes := (lookups or {}).get(entry["rule"])) is not None and entry["rule"] in LOOKUP_RULES}
    ready = dict(zip(wanted, checked_all(list(wanted.values())), strict=True))
    for entry in rules:
        rule, columns = entry["rule"], entry["columns"]
        if rule in RULES:
            # Entries of one rule may build on each other, as entries of the list do.
            for group in _independent(rule, columns):
                df = RULES[rule](df, group)
        elif rule in LOOKUP_RULES:
            if lookups is None or rule not in lookups:
                raise ValueError(f"rule {rule!r} needs a code list")
            take, default = LOOKUP_RULES[rule]
            for spec in columns:
                df = lookup(df, spec["src_col"], spec["tgt_col"], ready[id(lookups[rule])], take, default)
        else:
            raise ValueError(f"unknown cleansing rule {rule!r}")
    return df


def _independent(rule: str, columns: Sequence) -> list[list]:
    """Splits entries where one reads a column that an earlier one of the group wrote."""
    groups: list[list] = []
    written: set[str] = set()
    for spec in columns:
        if isinstance(spec, str):
            reads = writes = {spec}
        else:
            src = spec["src_col"]
            reads = set(src) if isinstance(src, list) else {src}
            writes = {spec.get("tgt_col", src)}
            if rule in ("trim_whitespace", "ascii_only", "rtrim"):
                writes = writes | reads
        if not groups or reads & written:
            groups.append([])
            written = set()
        groups[-1].append(spec)
        written |= writes
    return groups


def clean_date_suffix(df: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """Adds ``c_{column}`` for each column whose name ends in one of the suffixes."""
    simple = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NumericType, T.BooleanType)
    matching = [
        f.name
        for f in df.schema.fields
        if f.name.endswith(tuple(suffixes)) and isinstance(f.dataType, simple)
    ]
    return df.withColumns({f"c_{n}": c.date_text(F.col(n)) for n in matching})
