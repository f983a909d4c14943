"""Contract checks on raw JSON text: presence, JSON type, constants, enum and range."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskweave import constants as K, schemas as S

ERRORS = "_validation_errors"


@dataclass(frozen=True)
class Contract:
    """Required fields with their JSON kind and the constants an event must carry."""

    schema: T.StructType
    constants: dict[str, str] = field(default_factory=dict)

    def kinds(self) -> dict[str, str]:
        names = {"double": "number", "int": "int", "string": "text"}
        return {f.name: names[f.dataType.simpleString()] for f in self.schema.fields}


SCORING = Contract(S.SCORING_EVENT, {"contract_version": K.CONTRACT_V1})
STATE = Contract(
    S.STATE_EVENT,
    {
        "contract_version": K.CONTRACT_STATE,
        "state_operation": K.STATE_OPERATION,
        "state_store_version": K.STATE_STORE_VERSION,
    },
)


def _json_kind(name: str) -> Column:
    """Type name of one field of the variant column ``_v``; NULL when absent."""
    return F.schema_of_variant(F.try_variant_get("_v", f"$.{name}", "variant"))


# JSON booleans pass as whole numbers in the checked contract.  Whole numbers past 64
# bits read as wide decimals; a short DECIMAL(n,0) is a float such as 25.0.
_WIDE = r"DECIMAL\((?:19|[23][0-9]),0\)"
_KINDS = {"int": rf"^(?:BIGINT|BOOLEAN|{_WIDE})$", "number": r"^(?:BIGINT|BOOLEAN|DOUBLE|FLOAT|DECIMAL.*)$"}


def _type_ok(kind: Column, wanted: str) -> Column:
    """One test each, as every mention of ``kind`` reads the field again."""
    return kind == "STRING" if wanted == "text" else kind.rlike(_KINDS[wanted])


def contract_errors(raw: DataFrame, contract: Contract, text: str = "value") -> DataFrame:
    """Add every violation of a JSON text as an array of names.

    The raw text decides between ``missing:f`` and ``type:f``: a parsed struct would show
    NULL for both.  JSON null is present, so it counts as a wrong type.
    """
    parsed = raw.withColumn("_v", F.try_parse_json(text)).withColumn(
        "_keys", F.json_object_keys(text)
    )
    tests = []
    for name, wanted in contract.kinds().items():
        kind = _json_kind(name)
        present = F.array_contains("_keys", name)
        tests.append(
            F.when(~F.coalesce(present, F.lit(False)), f"missing:{name}").when(
                ~F.coalesce(_type_ok(kind, wanted), F.lit(False)), f"type:{name}"
            )
        )
    for name, value in contract.constants.items():
        actual = F.try_variant_get("_v", f"$.{name}", "string")
        tests.append(F.when(~actual.eqNullSafe(F.lit(value)), name))
    score = F.try_variant_get("_v", "$.risk_score", "bigint")
    counted = F.coalesce(_json_kind("risk_score").rlike(rf"^(?:BIGINT|{_WIDE})$"), F.lit(False))
    tests.append(
        F.when(counted & ~F.coalesce(score.between(0, 100), F.lit(False)), "risk_score_range")
    )
    level = F.try_variant_get("_v", "$.risk_level", "string")
    tests.append(F.when(~F.coalesce(level.isin(*K.ALL_RISK_LEVELS), F.lit(False)), "risk_level"))
    # exploding a one-element array keeps later filters on the errors above this long
    # expression; pushed below it they would evaluate it a second time
    found = F.array_compact(F.array(*tests))
    return parsed.select(*raw.columns, F.explode(F.array(found)).alias(ERRORS))


def validate_contract(
    raw: DataFrame, contract: Contract, text: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(valid events as typed columns, invalid raw text with all its errors)."""
    return split_checked(contract_errors(raw, contract, text), contract, text)


def split_checked(
    checked: DataFrame, contract: Contract, text: str = "value"
) -> tuple[DataFrame, DataFrame]:
    keep = [c for c in checked.columns if c not in (text, ERRORS)]
    valid = (
        checked.filter(F.size(ERRORS) == 0)
        .select(*keep, F.from_json(text, contract.schema).alias("_e"))
        .select(*keep, "_e.*")
    )
    return valid, checked.filter(F.size(ERRORS) > 0)
