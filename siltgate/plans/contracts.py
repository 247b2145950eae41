"""Contracts: what is known about each source. A load is driven by its contract alone."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Literal

from siltgate.functions.rules import (
    BLANK_VALUES,
    SCRUB_VALUES,
    Blank,
    CodeLength,
    Corrupt,
    Rule,
    SpecialChar,
)
from siltgate.sources.feed import parse_declaration


@dataclass(frozen=True)
class Contract:
    """Schema, quality rule and merge mode of one source.

    `check_columns` are the columns the quality rule looks at; with none, no row is rejected or changed. Cells that
    do not fit the schema are NULL unless `keep_corrupt` sends their lines to quarantine, as it does by default for `scd1`. `append` sources store a
    day's rows as that day's folder; the other modes store the whole table per day. With `buckets`, snapshots of an
    `scd1` source are laid out by hash of the key, so that merging does not move them however much a day changes.
    With `origin`, quarantined rows say in which file and block they were read.
    `key_type` casts the key (of one column, declared as text) before rows are merged; text that does not fit is NULL.
    """

    source: str
    schema: str
    quality: Literal["special_char", "blank", "scrub", "none"] = "none"
    check_columns: tuple[str, ...] = ()
    code_lengths: Mapping[str, int] = field(default_factory=dict)
    merge_mode: Literal["scd1", "append", "full"] = "full"
    key: tuple[str, ...] = ()
    tie_break: tuple[str, ...] | None = None
    buckets: int = 0
    header: bool = False
    flags: tuple[str, ...] = ()
    keep_corrupt: bool | None = None
    origin: bool = False
    key_type: str | None = None
    blank_values: tuple[str, ...] = BLANK_VALUES
    scrub_values: tuple[str, ...] = SCRUB_VALUES
    quarantine_header: bool = False
    quarantine_mode: Literal["ignore", "overwrite"] = "overwrite"

    def __post_init__(self) -> None:
        if self.keep_corrupt is None:
            # Lines with an unreadable key would else become one row with NULL as its key.
            object.__setattr__(self, "keep_corrupt", self.merge_mode == "scd1")
        if self.merge_mode == "scd1" and not self.key:
            raise ValueError(f"{self.source}: an scd1 source needs a key")
        if self.buckets and self.merge_mode != "scd1":
            raise ValueError(f"{self.source}: only scd1 snapshots can be bucketed")

    @property
    def rules(self) -> list[Rule]:
        rules: list[Rule] = [Corrupt()] if self.keep_corrupt else []
        if self.quality == "special_char" and self.check_columns:
            rules.append(SpecialChar(self.check_columns))
        if self.quality == "blank" and self.check_columns:
            rules.append(Blank(self.check_columns, self.blank_values))
        if self.code_lengths:
            rules.append(CodeLength(self.code_lengths))
        return rules


def declared_contract(source: str, text: str, **rest) -> Contract:
    """A contract whose schema and checked columns come from a declaration as `parse_declaration` reads it."""
    schema, checked = parse_declaration(text)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return Contract(source, ddl, check_columns=tuple(checked), **rest)
