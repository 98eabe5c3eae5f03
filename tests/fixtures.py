"""Fixture files for the media sources (shapes from FIXTURES.md, rows
invented).  Written by the tests into a fresh temporary directory."""

from __future__ import annotations

import csv
import json
import os

META_HEADER = ["date", "timestamp_pst", "campaign_id", "campaign_name", "adset_id", "ad_id",
               "objective", "placement", "impressions", "clicks", "spend_usd", "currency",
               "conversions", "conversion_value_usd"]

META_ROWS = [
    # USD
    ["2026-01-05", "2026-01-05 10:00:00", "1001", "NW_App_East", "as1", "ad1", "conv", "feed",
     "1000", "50", "100.00", "USD", "5", "300"],
    # lower-case padded CAD, January rate 0.74
    ["2026-01-05", "2026-01-05 11:00:00", "1002", "NW_Fur_East", "as1", "ad2", "conv", "feed",
     "2000", "80", "200.00", " cad ", "4", "250"],
    # GBP, February rate 1.27: 300.50 * 1.27 = 381.635 -> 381.64
    ["2026-02-10", "2026-02-10 09:30:00", "1003", "NW_Out_West", "as2", "ad3", "conv", "story",
     "1500", "30", "300.50", "GBP", "3", "400"],
    # missing currency -> assumed USD
    ["2026-03-01", "2026-03-01 08:00:00", "1004", "NW_Sea_Nat", "as3", "ad4", "reach", "feed",
     "900", "10", "50.00", "", "1", "90"],
    # EUR has no rate -> factor 1.0, note still says converted
    ["2026-03-02", "2026-03-02 08:00:00", "1005", "NW_Sea_Nat", "as3", "ad5", "reach", "feed",
     "800", "12", "70.00", "EUR", "2", "80"],
    # CAD in July: no rate
    ["2026-07-15", "2026-07-15 08:00:00", "1006", "NW_App_Nat", "as4", "ad6", "conv", "feed",
     "700", "7", "80.00", "CAD", "1", "70"],
    # summer timestamp: fixed +8 h, empty conversions -> 0.0
    ["2026-06-01", "2026-06-01 12:00:00", "1001", "NW_App_East", "as1", "ad7", "conv", "feed",
     "600", "6", "60.00", "USD", "", ""],
    # bad timestamp -> NULL; tab / non-breaking-space padding in the name
    ["2026-06-02", "not a time", "1001", "\tNW_App_East ", "as1", "ad8", "conv", "feed",
     "500", "5", "50.00", "USD", "1", "10"],
    # non-numeric impressions -> quarantine
    ["2026-06-03", "2026-06-03 12:00:00", "1001", "NW_App_East", "as1", "ad9", "conv", "feed",
     "12x", "5", "50.00", "USD", "1", "10"],
    # exact key duplicate in one file: first wins (spend 11.00 kept)
    ["2026-04-01", "2026-04-01 10:00:00", "1002", "NW_Fur_East", "as9", "ad9", "conv", "feed",
     "100", "1", "11.00", "USD", "1", "10"],
    ["2026-04-01", "2026-04-01 10:00:00", "1002", "NW_Fur_East", "as9", "ad9", "conv", "feed",
     "100", "1", "99.00", "USD", "1", "10"],
    # two names for one silver key-day (D2): both in bronze, one in silver
    ["2026-04-02", "2026-04-02 10:00:00", "1003", "Old_Name", "as2", "ad3", "conv", "story",
     "100", "1", "20.00", "USD", "1", "10"],
    ["2026-04-02", "2026-04-02 10:00:00", "1003", "New_Name", "as2", "ad3", "conv", "story",
     "100", "1", "30.00", "USD", "1", "10"],
]


def google_lines():
    def rec(date, ts, cid, name, chan, imp, cost=2_500_000, conv=1.25, value=9_000_000,
            **extra):
        m = {"impressions": imp, "clicks": 4, "cost_micros": cost, "conversions": conv,
             "conversions_value_micros": value}
        m.update(extra)
        r = {"date": date, "campaign": {"id": cid, "name": name,
                                        "advertising_channel_type": chan}, "metrics": m}
        if ts is not None:
            r["timestamp_utc"] = ts
        return json.dumps(r)

    return [
        rec("2026-02-03", "2026-02-03T00:00:00Z", 7, "G1", "SEARCH", 100),   # numeric id
        "",                                                                    # blank line
        "{not json",                                                           # unparseable
        json.dumps({"date": "2026-02-03", "campaign": "oops",
                    "metrics": {"impressions": 1, "clicks": 1, "cost_micros": 1,
                                "conversions": 1, "conversions_value_micros": 1}}),
        json.dumps({"date": "2026-02-04", "timestamp_utc": "2026-02-04T00:00:00Z",
                    "campaign": {"id": "8", "name": "G2",
                                 "advertising_channel_type": "VIDEO"}}),  # no metrics
        rec("2026-02-04", "2026-02-04T00:00:00Z", "13", "G5", "SEARCH", "6.0",
            video_views=5),                                       # 6.0 and an extra key
        # different timestamps: newest wins although it has fewer impressions
        rec("2026-02-05", "2026-02-05T01:00:00Z", "9", "G3", "SEARCH", 500),
        rec("2026-02-05", "2026-02-05T05:00:00Z", "9", "G3", "SEARCH", 100),
        # equal timestamps: most impressions wins
        rec("2026-02-06", "2026-02-06T01:00:00Z", "10", "G4", "SEARCH", 100),
        rec("2026-02-06", "2026-02-06T01:00:00Z", "10", "G4", "SEARCH", 300),
        # two rows share the newest timestamp: first in input wins
        rec("2026-02-07", "2026-02-07T01:00:00Z", "11", "G6", "SEARCH", 10),
        rec("2026-02-07", "2026-02-07T09:00:00Z", "11", "G6", "SEARCH", 20),
        rec("2026-02-07", "2026-02-07T09:00:00Z", "11", "G6", "SEARCH", 30),
        # missing and present timestamps: the present (newer) one wins
        rec("2026-02-08", None, "12", "G7", "SEARCH", 50),
        rec("2026-02-08", "2026-02-08T02:00:00Z", "12", "G7", "SEARCH", 40),
    ]


VISITS_HEADER = ["date", "dma_code", "dma_name", "attributed_visits", "attribution_window_days"]
VISITS_ROWS = [
    ["2026-01-01", "501", "New York", "100", "7"],
    ["2026-01-01", "803", "Los Angeles", "80", "7"],
    ["2026-01-01", "999", "Nowhere", "5", "7"],          # DMA missing from the region map
    ["2026-01-02", "501", "New York", "110", "7"],
    ["2026-01-02", "803", "Los Angeles", "90", "28"],
    ["2026-01-03", "803", "Los Angeles", "95", "7"],     # 501 missing on 01-03
    # 01-04 missing for every DMA
    ["2026-01-05", "501", "New York", "120", "7"],
    ["2026-01-05", "803", "Los Angeles", "70", "7"],
]

METADATA_HEADER = ["campaign_id", "brand", "product_line", "region", "campaign_start_date",
                   "campaign_end_date", "budget_usd"]
METADATA_ROWS = [
    ["1001", "Northwind", "Appliances", "East", "2026-01-01", "2026-06-30", "500"],
    ["1002", "Northwind", "Appliances", "East", "2026-01-01", "2026-04-30", ""],   # peer: 1001
    ["1003", "Northwind", "Outdoor", "West", "2026-02-01", "2026-04-30", "0"],      # zero budget
    ["1004", "Northwind", "Seasonal", "National", "2026-03-01", "2026-03-31", "40"],
    ["1005", "Northwind", "Seasonal", "National", "2026-03-01", "2026-03-31", ""],
    ["1006", "Northwind", "Furniture", "National", "2026-07-01", "2026-07-31", ""],  # no peer
    ["1007", "Northwind", "Furniture", "East", "2026-01-01", "2026-01-31", "100"],   # no spend
    ["1008", "Northwind", "Furniture", "East", "2026-01-01", "2026-01-31", "abc"],   # bad budget
]


def _csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def write_landing(directory: str, meta=META_ROWS, visits=VISITS_ROWS,
                  metadata=METADATA_ROWS, google=None) -> str:
    os.makedirs(directory, exist_ok=True)
    _csv(os.path.join(directory, "meta_ads_daily.csv"), META_HEADER, meta)
    _csv(os.path.join(directory, "store_visits.csv"), VISITS_HEADER, visits)
    _csv(os.path.join(directory, "campaign_metadata.csv"), METADATA_HEADER, metadata)
    with open(os.path.join(directory, "google_ads_daily.json"), "w", encoding="utf-8") as f:
        f.write("\n".join(google if google is not None else google_lines()) + "\n")
    return directory
