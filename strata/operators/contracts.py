"""Layer contracts (CON-1..3, INC-5): declared schemas and constraints.

A contract is checked on ``df.schema`` (metadata only) before a write; the
not-null / unique constraints run as data-quality checks
(:mod:`strata.operators.quality`) and raise before publishing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.functions.names import naming_violations
from strata.operators import quality as DQ

TS = T.TimestampType()
MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(5, 4)
MONEY_SUM = T.DecimalType(38, 2)


class ContractError(ValueError):
    """Columns, types or constraints differ from the declared contract."""


@dataclass
class Contract:
    name: str
    schema: T.StructType
    not_null: Sequence[str] = field(default_factory=tuple)
    unique: Sequence[str] = field(default_factory=tuple)

    def check_schema(self, df: DataFrame) -> None:
        """CON-1: same column set and types (order-insensitive: we bind by
        name)."""
        want = {f.name: f.dataType for f in self.schema.fields}
        got = {f.name: f.dataType for f in df.schema.fields}
        missing = sorted(set(want) - set(got))
        extra = sorted(set(got) - set(want))
        wrong = sorted(n for n in set(want) & set(got) if want[n] != got[n])
        if missing or extra or wrong:
            raise ContractError(f"{self.name}: missing {missing}, unexpected {extra}, "
                                f"type mismatch {[(n, got[n].simpleString(), want[n].simpleString()) for n in wrong]}")

    def check_constraints(self, df: DataFrame) -> None:
        """CON-2: not-null columns fused in one aggregate; unique key by one
        grouped aggregate; only counts reach the driver."""
        if self.not_null:
            from pyspark.sql import functions as F
            row = df.agg(*[F.count_if(DQ.cond_not_null(c)).alias(c) for c in self.not_null]).first()
            bad = [c for c in self.not_null if row[c]]
            if bad:
                raise ContractError(f"{self.name}: NULLs in not-null columns {bad}")
        if self.unique and not DQ.unique(df, list(self.unique)).isEmpty():
            raise ContractError(f"{self.name}: duplicate values of {list(self.unique)}")

    def enforce(self, df: DataFrame, constraints: bool = True) -> DataFrame:
        self.check_schema(df)
        if constraints:
            self.check_constraints(df)
        return df.select(*[f.name for f in self.schema.fields])

    def naming(self) -> list[tuple[str, str, str]]:
        """CON-3: naming-rule violations of the declared columns."""
        return naming_violations(self.schema, self.name)


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


S = T.StringType()
# The declared layer contracts.
CONTRACTS = {
    "stg_customer": Contract("stg_customer", _s(("customer_id", T.IntegerType(), False),
                                                ("customer_name", S, False), ("has_loan_flag", T.BooleanType(), False),
                                                ("loaded_at", TS, False)),
                             not_null=("customer_id", "customer_name", "has_loan_flag", "loaded_at"),
                             unique=("customer_id",)),
    "stg_account": Contract("stg_account", _s(("account_id", S, False), ("customer_id", T.IntegerType(), False),
                                              ("balance_amount", MONEY, False), ("account_type", S, False),
                                              ("loaded_at", TS, False)),
                            not_null=("account_id", "customer_id", "balance_amount", "account_type", "loaded_at"),
                            unique=("account_id",)),
    "int_account_with_customer": Contract(
        "int_account_with_customer",
        _s(("account_id", S, False), ("customer_id", T.IntegerType(), False), ("balance_amount", MONEY, False),
           ("account_type", S, False), ("customer_name", S, False), ("has_loan_flag", T.BooleanType(), False),
           ("valid_from_at", TS, False), ("valid_to_at", TS, True)),
        not_null=("account_id", "customer_id"), unique=("account_id",)),
    "int_savings_account_only": Contract(
        "int_savings_account_only",
        _s(("account_id", S, False), ("customer_id", T.IntegerType(), False), ("customer_name", S, False),
           ("balance_amount", MONEY, False), ("has_loan_flag", T.BooleanType(), False),
           ("valid_from_at", TS, False), ("valid_to_at", TS, True)),
        not_null=("account_id", "customer_id"), unique=("account_id",)),
    "account_summary": Contract(
        "account_summary",
        _s(("account_id", S, False), ("customer_id", T.IntegerType(), False),
           ("original_balance_amount", MONEY, False), ("interest_rate_pct", RATE, False),
           ("annual_interest_amount", MONEY, False), ("new_balance_amount", MONEY, False),
           ("calculated_at", TS, False)),
        not_null=("account_id", "customer_id", "original_balance_amount", "interest_rate_pct"),
        unique=("account_id",)),
    "customer_profile": Contract(
        "customer_profile",
        _s(("customer_id", T.IntegerType(), False), ("customer_name", S, True), ("has_loan_flag", T.BooleanType(), True),
           ("total_accounts_count", T.LongType(), False), ("total_balance_amount", MONEY_SUM, True),
           ("total_annual_interest_amount", MONEY_SUM, True), ("calculated_at", TS, True)),
        not_null=("customer_id",), unique=("customer_id",)),
}
SCD = (("dbt_scd_id", S, False), ("dbt_updated_at", TS, False), ("dbt_valid_from", TS, False), ("dbt_valid_to", TS, True))
_RAW = {"customer": ("customer_id", "name", "has_loan"), "account": ("account_id", "customer_id", "balance", "account_type")}
for _t, _cols in _RAW.items():
    _raw = [(c, S, True) for c in _cols] + [("loaded_at", TS, False), ("malformed_record", S, True)]
    CONTRACTS[f"src_{_t}"] = Contract(f"src_{_t}", _s(*_raw))
    CONTRACTS[f"quarantine_stg_{_t}"] = Contract(f"quarantine_stg_{_t}", _s(*_raw, ("failure_reason", S, False), ("quarantined_at", TS, False)))
    _stg = CONTRACTS[f"stg_{_t}"].schema.fields
    CONTRACTS[f"snap_{_t}"] = Contract(f"snap_{_t}", _s(*((f.name, f.dataType, f.nullable) for f in _stg), *SCD), unique=("dbt_scd_id",))


def contracts(id_type: str = "int") -> dict[str, Contract]:
    """The declared contracts with customer ids of the given type; every
    column declared without NULLs is a not-null constraint."""
    def typed(f: T.StructField) -> T.StructField:
        is_id = f.name == "customer_id" and isinstance(f.dataType, T.IntegerType)
        return T.StructField(f.name, T.LongType() if is_id and id_type == "bigint" else f.dataType, f.nullable)

    return {n: Contract(n, T.StructType([typed(f) for f in c.schema.fields]),
                        tuple(f.name for f in c.schema.fields if not f.nullable), c.unique) for n, c in CONTRACTS.items()}
