"""Pseudonyms, minimisation and the gate before loading."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.reference import TREATMENTS
from wardflow.session import short_table

AUDIT_COLUMNS = {
    "colonne": "string", "operation": "string", "justification": "string",
    "horodatage": "string", "nb_lignes_traitees": "bigint", "execution_id": "string",
}


def required_salt(salt: str | None, variable: str) -> str:
    """The salt given, or that of the environment variable; never none."""
    salt = salt or os.environ.get(variable)
    if not salt:
        raise ValueError(
            f"no pseudonym salt: pass one or set the environment variable {variable}"
        )
    return salt


def hidden_constant(df: DataFrame, value: str) -> Column:
    """A secret as a scalar subquery, so that no query plan spells it out."""
    return short_table(df.sparkSession, [(value,)], {"__secret": "string"}).scalar()


def pseudonym(identifier: Column, salt: Column, missing_text: str | None = None) -> Column:
    """First 16 hexadecimal digits of SHA-256 over salt and identifier.

    A missing identifier gives no pseudonym: two unknown people are not one
    person. ``missing_text`` hashes it as that text instead.
    """
    text = identifier.cast("string")
    if missing_text is not None:
        text = F.coalesce(text, F.lit(missing_text))
    return F.substring(F.sha2(F.concat(salt, text), 256), 1, 16)


def add_pseudonym(
    df: DataFrame, identifier: str, name: str, salt: str, missing_text: str | None = None
) -> DataFrame:
    """Replace an identifier by its pseudonym, added as the last column."""
    code = pseudonym(F.col(identifier), hidden_constant(df, salt), missing_text)
    return df.withColumn(name, code).drop(identifier)


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def generalise_to_year(df: DataFrame, date: str, name: str) -> DataFrame:
    """Replace a date by its year; nothing to do when it is absent."""
    if date not in df.columns:
        return df
    return df.withColumn(name, F.year(date)).drop(date)


def pseudonymise(
    df: DataFrame,
    salt: str,
    identifier: str,
    direct: Sequence[str],
    birth: str,
    pseudonym_name: str = "id_patient_pseudo",
    year_name: str = "annee_naissance",
    missing_text: str | None = None,
) -> DataFrame:
    """Hash the identifier, drop direct identifiers, keep the birth year."""
    return generalise_to_year(
        add_pseudonym(df, identifier, pseudonym_name, salt, missing_text).drop(*direct),
        birth,
        year_name,
    )


def treatments(
    df: DataFrame, identifier: str, direct: Sequence[str], birth: str
) -> list[tuple[str, str, str]]:
    """The treatments :func:`pseudonymise` applies to this table."""
    rows = [(identifier, *TREATMENTS["hashed"])]
    rows += [(name, *TREATMENTS["dropped"]) for name in present(df, direct)]
    rows += [(name, *TREATMENTS["generalised"]) for name in present(df, [birth])]
    return rows


def treatment_audit(
    df: DataFrame,
    identifier: str,
    direct: Sequence[str],
    birth: str,
    rows_treated: int,
    moment: datetime | None = None,
) -> DataFrame:
    """One row per treatment, stamped with the time and a run identifier."""
    stamp = (moment or datetime.now()).isoformat(timespec="seconds")
    run = hashlib.md5(stamp.encode()).hexdigest()[:8]
    rows = [
        (*treatment, stamp, rows_treated, run)
        for treatment in treatments(df, identifier, direct, birth)
    ]
    return short_table(df.sparkSession, rows, AUDIT_COLUMNS)


def check_no_personal_columns(df: DataFrame, forbidden: Sequence[str]) -> bool:
    """Raise when a personal column is left; reads the schema only."""
    found = present(df, forbidden)
    if found:
        raise AssertionError(f"personal columns left before loading: {found}")
    return True
