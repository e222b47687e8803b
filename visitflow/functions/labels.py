"""Code-to-label columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitflow import codes


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c, mapping: Mapping) -> Column:
    """Label of a code; codes outside the mapping have none."""
    label = F.lit(None).cast("string")
    for code, text in mapping.items():
        label = F.when(_col(c) == code, text).otherwise(label)
    return label


def status_label(c) -> Column:
    return decode(c, codes.STATUS_LABELS)


def face_to_face(c, types: Iterable[str] = codes.FACE_TO_FACE_TYPES) -> Column:
    return F.when(_col(c).isin(*types), 1).otherwise(0)


def link_flag(linked_id, yes: str = "Y", no: str = "N") -> Column:
    return F.when(_col(linked_id).isNull(), no).otherwise(yes)


def administration_status(due_code, result_name) -> Column:
    due, name = _col(due_code), _col(result_name)
    undue = F.when(name.isin("Taken", "Missed"), F.concat(name, F.lit(": "))).otherwise(name)
    return F.when(due.isNull(), undue).when(due == 1, "Due")


def user_label(user_id, employee_id, employee_name) -> Column:
    user, emp, name = _col(user_id), _col(employee_id), _col(employee_name)
    return (
        F.when(user.isNull(), "")
        .when(emp.isNull(), F.concat(F.lit("Unknown: "), user))
        .when(name.isNull(), F.concat(F.lit("No Name: "), emp))
        .otherwise(F.concat(name, F.lit(" - "), emp))
    )


def canonical_code(c, aliases: Iterable[str], canonical: str) -> Column:
    return F.when(_col(c).isin(*aliases), canonical).otherwise(_col(c))
