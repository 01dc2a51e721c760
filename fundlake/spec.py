"""Declarative ingestion specs.

A spec says how a delimited file maps onto a typed table: which file field
(by position) feeds which column, which SQL expression transforms a field,
the table's column types and constraints, the reader options and the named
procedure to run after a load. A new ingestion is a new ``IngestSpec`` value.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Any, Mapping


@dataclass(frozen=True)
class TargetColumn:
    name: str
    type: str  # Spark SQL type text: "varchar(10)", "decimal(5,2)", "date", "bigint"...
    nullable: bool = True


@dataclass(frozen=True)
class IngestSpec:
    name: str
    target_table: str
    columns: tuple[TargetColumn, ...]
    # (source field, target column) in file order: binding is positional, the
    # source name is only a variable name for transforms.
    field_mappings: tuple[tuple[str, str], ...]
    # source field -> Spark SQL expression; "@Field" names a raw file field.
    field_transformations: Mapping[str, str] = field(default_factory=lambda: MappingProxyType({}))
    unique_key: tuple[str, ...] = ()
    key_collation: str | None = "UNICODE_CI_AI_RTRIM"
    surrogate_id: str | None = None
    #: a date or integer column by which the table is partitioned
    partition_by: str | None = None
    procedure_name: str | None = None
    procedure_params: Mapping[str, Any] = field(default_factory=lambda: MappingProxyType({}))
    # reader options
    delimiter: str = ","
    quote_char: str = '"'
    escape_char: str = "\\"
    line_terminator: str = "\n"
    skip_lines: int = 1
    null_marker: str = "\\N"
    multiline: bool = False
    encoding: str = "UTF-8"

    @property
    def source_fields(self) -> tuple[str, ...]:
        return tuple(s for s, _ in self.field_mappings)

    def column(self, name: str) -> TargetColumn:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def ddl(self) -> str:
        cols = []
        if self.surrogate_id:
            cols.append(f"`{self.surrogate_id}` BIGINT NOT NULL")
        for c in self.columns:
            cols.append(f"`{c.name}` {c.type.upper()}{'' if c.nullable else ' NOT NULL'}")
        return ", ".join(cols)

    def with_options(self, **kw) -> "IngestSpec":
        from dataclasses import replace
        return replace(self, **kw)


# --- Shipped specs. Column names, types, sizes, the transforms
# and the procedure names are those of the reference's staging tables. ---

CLASS_FEES = IngestSpec(
    name="Import Web ClassFees",
    target_table="FundClassFee",
    columns=(
        TargetColumn("FundCode", "varchar(10)", False),
        TargetColumn("FundName", "varchar(100)", False),
        TargetColumn("Class", "varchar(10)", False),
        TargetColumn("Description", "varchar(50)", False),
        TargetColumn("Mer", "decimal(5,2)"),
        TargetColumn("Trailer", "decimal(5,2)"),
        TargetColumn("PerformanceFee", "varchar(50)"),
        TargetColumn("MinInvestmentInitial", "varchar(20)"),
        TargetColumn("MinInvestmentSubsequent", "varchar(20)"),
        TargetColumn("Currency", "varchar(3)", False),
    ),
    field_mappings=(
        ("FundCode", "FundCode"),
        ("FundName", "FundName"),
        ("Class", "Class"),
        ("Description", "Description"),
        ("Mer", "Mer"),
        ("Trailer", "Trailer"),
        ("PerformanceFee", "PerformanceFee"),
        ("MinInvestmentInitial", "MinInvestmentInitial"),
        ("MinInvestmentSubsequent", "MinInvestmentSubsequent"),
        ("Currency", "Currency"),
    ),
    field_transformations=MappingProxyType({
        "Trailer": "NULLIF(@Trailer, '')",
        "PerformanceFee": "NULLIF(@PerformanceFee, '')",
        "MinInvestmentInitial": "NULLIF(@MinInvestmentInitial, '')",
        "MinInvestmentSubsequent": "NULLIF(@MinInvestmentSubsequent, '')",
    }),
    unique_key=("FundCode", "Class"),
    surrogate_id="id",
    procedure_name="usp_FundClassFee_Load",
)

HOLDINGS = IngestSpec(
    name="Import Web Hold",
    target_table="holdweb",
    columns=(
        TargetColumn("date", "date", False),
        TargetColumn("fund_name", "varchar(128)", False),
        TargetColumn("sec_name", "varchar(255)", False),
        TargetColumn("sector", "varchar(255)", False),
        TargetColumn("currency", "varchar(8)"),
        TargetColumn("units", "decimal(21,6)"),
        TargetColumn("cost", "decimal(21,6)"),
        TargetColumn("mv", "decimal(21,6)"),
    ),
    field_mappings=(
        ("date", "date"),
        ("fund_name", "fund_name"),
        ("sec_name", "sec_name"),
        ("sector", "sector"),
        ("currency", "currency"),
        ("units", "units"),
        ("cost", "cost"),
        ("mv", "mv"),
    ),
    procedure_name="usp_holdweb_process",
)
