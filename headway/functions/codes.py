"""Names of the numeric codes found in realtime rows."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Code names of the realtime wire format.
TRIP_RELATIONSHIP = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED",
                     5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED", 8: "NEW"}
STOP_RELATIONSHIP = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}
VEHICLE_STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}
CAUSE = {1: "UNKNOWN_CAUSE", 2: "OTHER_CAUSE", 3: "TECHNICAL_PROBLEM", 4: "STRIKE",
         5: "DEMONSTRATION", 6: "ACCIDENT", 7: "HOLIDAY", 8: "WEATHER", 9: "MAINTENANCE",
         10: "CONSTRUCTION", 11: "POLICE_ACTIVITY", 12: "MEDICAL_EMERGENCY"}
EFFECT = {1: "NO_SERVICE", 2: "REDUCED_SERVICE", 3: "SIGNIFICANT_DELAYS", 4: "DETOUR",
          5: "ADDITIONAL_SERVICE", 6: "MODIFIED_SERVICE", 7: "OTHER_EFFECT",
          8: "UNKNOWN_EFFECT", 9: "STOP_MOVED", 10: "NO_EFFECT", 11: "ACCESSIBILITY_ISSUE"}
SEVERITY = {1: "UNKNOWN_SEVERITY", 2: "INFO", 3: "WARNING", 4: "SEVERE"}
INCREMENTALITY = {0: "FULL_DATASET", 1: "DIFFERENTIAL"}

CODES = {"trip_relationship": TRIP_RELATIONSHIP, "stop_relationship": STOP_RELATIONSHIP,
         "vehicle_status": VEHICLE_STATUS, "cause": CAUSE, "effect": EFFECT,
         "severity": SEVERITY, "incrementality": INCREMENTALITY}


def code_label(kind: str, code: Column) -> Column:
    """Name of ``code`` in the list ``kind``; NULL where the list has no such code."""
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(CODES[kind].items())])
    return F.try_element_at(names, code.cast("int"))


def code_number(kind: str, label: Column) -> Column:
    """Code of the name ``label`` in the list ``kind``; NULL where the list has no such name."""
    codes = F.create_map(*[F.lit(x) for code, name in CODES[kind].items() for x in (name, code)])
    return F.try_element_at(codes, label)
