"""Hand-written raw flights: one per rule."""

from __future__ import annotations

from routeloom.schemas import RAW_COLUMNS

IGNORED = ("dep_time", "air_time")

DEFAULT = {
    "year": "2024", "month": "3", "day_of_month": "5", "day_of_week": "2",
    "fl_date": "2024-03-05", "op_unique_carrier": "AA", "op_carrier_fl_num": "12.0",
    "origin": "JFK", "origin_city_name": "New York, NY", "origin_state_nm": "New York",
    "dest": "LAX", "dest_city_name": "Los Angeles, CA", "dest_state_nm": "California",
    "dep_delay": "0", "arr_delay": "0", "cancelled": "0.0", "cancellation_code": "",
    "diverted": "0", "distance": "2475.0", "carrier_delay": "", "weather_delay": "",
    "nas_delay": "", "security_delay": "", "late_aircraft_delay": "",
}

# name: (changes to the default, expected values) or None when the row must go
CASES = {
    "normal": ({}, {"route": "JFK-LAX", "departure_delay_band": "low", "is_cancelled": 0,
                    "primary_disruption_cause": "none", "op_carrier_fl_num": 12}),
    "text": ({"op_unique_carrier": " aa ", "origin": "jfk "},
             {"op_unique_carrier": "AA", "origin": "JFK"}),
    "below_15": ({"dep_delay": "14.99"}, {"departure_delay_band": "low"}),
    "at_15": ({"dep_delay": "15"}, {"departure_delay_band": "medium"}),
    "at_60": ({"dep_delay": "60"}, {"departure_delay_band": "medium"}),
    "above_60": ({"dep_delay": "60.01"}, {"departure_delay_band": "high"}),
    "early": ({"dep_delay": "-5"}, {"departure_delay_band": "low", "dep_delay": -5.0}),
    "no_dep": ({"dep_delay": ""}, {"departure_delay_band": "unknown", "dep_delay": None}),
    "cause_max": ({"carrier_delay": "10", "weather_delay": "30"},
                  {"primary_disruption_cause": "weather"}),
    "cause_tie": ({"carrier_delay": "20", "late_aircraft_delay": "20"},
                  {"primary_disruption_cause": "carrier"}),
    "late_tie": ({"nas_delay": "7", "late_aircraft_delay": "7"},
                 {"primary_disruption_cause": "nas"}),
    "zero_causes": ({"carrier_delay": "0", "nas_delay": "0"},
                    {"primary_disruption_cause": "none"}),
    "negative": ({"weather_delay": "-3"}, {"primary_disruption_cause": "none"}),
    "code_a": ({"cancelled": "1.0", "cancellation_code": "A"},
               {"primary_disruption_cause": "carrier", "is_cancelled": 1, "cancelled": 1}),
    "code_b": ({"cancelled": "1.0", "cancellation_code": "B"},
               {"primary_disruption_cause": "weather"}),
    "code_c": ({"cancelled": "1.0", "cancellation_code": "C"},
               {"primary_disruption_cause": "nas"}),
    "code_d": ({"cancelled": "1.0", "cancellation_code": "D"},
               {"primary_disruption_cause": "security"}),
    "no_code": ({"cancelled": "1.0"}, {"primary_disruption_cause": "cancellation_unknown"}),
    "odd_code": ({"cancelled": "1.0", "cancellation_code": "Z"},
                 {"primary_disruption_cause": "cancellation_unknown"}),
    "pushed_back": ({"cancelled": "1.0", "cancellation_code": "B", "dep_delay": "40",
                     "arr_delay": ""},
                    {"departure_delay_band": "medium", "primary_disruption_cause": "weather",
                     "arr_delay": None}),
    "cancelled_null": ({"cancelled": "", "nas_delay": "9"},
                       {"is_cancelled": 0, "primary_disruption_cause": "nas"}),
    "code_lower": ({"cancelled": "1", "cancellation_code": " b"},
                   {"primary_disruption_cause": "weather", "cancellation_code": "B"}),
    "diverted": ({"diverted": "1"}, None),
    "diverted_decimal": ({"diverted": "1.0"}, None),
    "diverted_null": ({"diverted": ""}, {"route": "JFK-LAX"}),
    "same_airport": ({"dest": " jfk"}, None),
    "month_13": ({"month": "13"}, None),
    "month_0": ({"month": "0"}, None),
    "month_null": ({"month": ""}, None),
    "month_decimal": ({"month": "3.0"}, {"month": 3}),
    "date_null": ({"fl_date": ""}, None),
    "date_bad": ({"fl_date": "2024-13-40"}, None),
    "blank_key": ({"origin": "  "}, None),
    "blank_carrier": ({"op_unique_carrier": " "}, None),
    "null_dest": ({"dest": ""}, None),
    "bad_number": ({"dep_delay": "abc"}, {"dep_delay": None, "departure_delay_band": "unknown"}),
    "not_a_number": ({"dep_delay": "NaN"}, {"departure_delay_band": "high"}),
    "tab": ({"origin": "\tJFK"}, {"origin": "\tJFK"}),
}


def _line(values) -> str:
    return ",".join(f'"{v}"' if "," in v or " " in v else v for v in values)


def raw_lines() -> list[str]:
    """A headed CSV; the flight number tells the case, extra columns stand in between."""
    names = ["dep_time", *RAW_COLUMNS, "air_time"]
    lines = [",".join(names)]
    for at, (changes, _) in enumerate(CASES.values()):
        row = {**DEFAULT, **changes, "op_carrier_fl_num": f"{at}.0", "dep_time": "1", "air_time": "2"}
        lines.append(_line(row[name] for name in names))
    return lines


def write_raw(folder) -> str:
    path = folder / "raw.csv"
    path.write_text("\n".join(raw_lines()) + "\n")
    return str(path)
