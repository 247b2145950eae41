"""Contracts of four sample sources: a file per day, or one file with a header each."""

from siltgate.plans.contracts import Contract

CARRIER = """
    carrier_id int, name string, alias string, short string, long string, callsign string, country string,
    active boolean
"""
STATION = """
    station_id int, name string, city string, country string, code string, long_code string,
    latitude decimal(18,9), longitude decimal(18,9), altitude decimal(18,9),
    zone string, dst string, zone_name string, kind string, origin string
"""
CRAFT = "Name string, short_code string, long_code string"
LEG = """
    carrier string, carrier_id int, start string, start_id int, target string, target_id int,
    shared string, stops string, equipment string
"""
LENGTHS = {"short": 2, "long": 3}
HEADED = dict(header=True, quarantine_header=True)

DAILY = {
    c.source: c
    for c in [
        Contract("station", STATION, quality="special_char", check_columns=("name", "city", "country"),
                 merge_mode="scd1", key=("station_id",)),
        Contract("carrier", CARRIER, flags=("active",), quality="blank",
                 check_columns=("carrier_id", "name", "short", "long"), code_lengths=LENGTHS,
                 merge_mode="scd1", key=("carrier_id",)),
        Contract("leg", LEG, quality="scrub",
                 check_columns=("carrier", "start", "target", "shared", "stops", "equipment"), merge_mode="append"),
        Contract("craft", CRAFT, merge_mode="full"),
    ]
}
SINGLE_FILE = {
    "craft": Contract("craft", CRAFT, quality="blank", check_columns=("Name", "short_code", "long_code"),
                      merge_mode="full", **HEADED),
}
