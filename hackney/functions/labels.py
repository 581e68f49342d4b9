"""Code-to-label expressions."""

from __future__ import annotations

from collections.abc import Mapping

from hackney.functions.text import literal

# Report labels.
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
PAYMENT_OTHER = "Unknown"
RATE_CODE_LABELS = {
    1: "Standard Rate",
    2: "JFK Airport",
    3: "Newark Airport",
    4: "Nassau/Westchester",
    5: "Negotiated Fare",
    6: "Group Ride",
}
RATE_CODE_OTHER = "Other/Unknown"
PEAK_PERIODS = {
    "Peak Evening (16-19)": (16, 19),
    "Peak Morning (07-09)": (7, 9),
}
OFF_PEAK = "Off-Peak"
WEEKEND, WEEKDAY = "Weekend", "Weekday"
VENDOR_LABELS = {1: "Creative Mobile Technologies", 2: "VeriFone Inc."}
VENDOR_OTHER = "Unknown"
MONTH_NAMES = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def label_of(code: str, labels: Mapping[int, str], other: str) -> str:
    cases = " ".join(f"WHEN {key} THEN {literal(label)}" for key, label in labels.items())
    return f"CASE {code} {cases} ELSE {literal(other)} END"


def payment_label(code: str) -> str:
    return label_of(code, PAYMENT_LABELS, PAYMENT_OTHER)


def rate_code_label(code: str) -> str:
    return label_of(f"try_cast({code} AS int)", RATE_CODE_LABELS, RATE_CODE_OTHER)


def vendor_label(code: str, labels: Mapping[int, str] = VENDOR_LABELS) -> str:
    return label_of(code, labels, VENDOR_OTHER)


def day_type(weekend: str) -> str:
    return label_of(weekend, {1: WEEKEND}, WEEKDAY)


def time_period(hour: str) -> str:
    cases = " ".join(
        f"WHEN {hour} BETWEEN {first} AND {last} THEN {literal(name)}"
        for name, (first, last) in PEAK_PERIODS.items()
    )
    return f"CASE {cases} ELSE {literal(OFF_PEAK)} END"


def month_label(year: str, month: str) -> str:
    name = label_of(month, dict(enumerate(MONTH_NAMES, start=1)), "")
    return f"concat({name}, ' ', CAST({year} AS string))"
