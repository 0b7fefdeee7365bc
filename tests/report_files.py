"""A small landing folder of report files that shows each kind of drift and fault."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

US_HEADER = (
    "Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,Recovered,Active,FIPS,Incident_Rate,"
    "Total_Test_Results,People_Tested,People_Hospitalized,Case_Fatality_Ratio,UID,ISO3,Testing_Rate,"
    "Hospitalization_Rate,Mortality_Rate,Date"
)
WITH_RATES = "Province_State,Country_Region,Last_Update,Confirmed,Deaths,Recovered,Active,Incident_Rate,Case_Fatality_Ratio"
SHORT_HEADER = "Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered"

GLOBAL_FILES = {
    # slashes and blanks in the header, slash dates, columns that came later are absent
    "01-22-2020.csv": f"{SHORT_HEADER}\nHubei,China,1/22/2020 17:00,444,17,28\n,Japan,1/22/2020 17:00,2,,\n",
    # two-digit year
    "02-01-2020.csv": f"{SHORT_HEADER}\nHubei,China,2/1/20 1:52,7153,249,168\n",
    # other order and other columns
    "03-22-2020.csv": (
        "FIPS,Admin2,Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,Recovered,Active,Combined_Key\n"
        '45001,Abbeville,South Carolina,US,2020-03-22 23:45:00,34.2,-82.4,1,0,0,0,"Abbeville, South Carolina, US"\n'
        ",,,Italy,2020-03-22 18:13:20,41.87,12.56,59138,5476,7024,46638,Italy\n"
    ),
    # a hyphen stays in the name, so that column is not the ratio; counts written as 7.0
    "06-01-2020.csv": (
        "Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,Recovered,Active,Incident_Rate,Case-Fatality_Ratio\n"
        ",Peru,2020-06-02 02:33:08,0,0,7.0,1.0,,,-1,14.2\n"
    ),
    # edges of the ratio
    "06-02-2020.csv": WITH_RATES + "\n" + "".join(
        f"P{i},Peru,2020-06-03 02:33:13,{i},0,0,0,1.5,{ratio}\n" for i, ratio in enumerate(["-1", "0", "100", "100.1", ""])
    ),
    # byte order mark, CRLF, quoted commas, texts for "no value", blanks only
    "06-03-2020.csv": "﻿" + WITH_RATES + "\r\n"
        + '"Hubei, Wuhan",China,2020-06-04 02:33:14,68135,4512,NA,nan,115.2,6.6\r\n'
        + "   ,  Chile  ,2020-06-04 02:33:14,113628,1275,N/A,,,\r\n\r\n",
    # countries that are left out of the fact, and a row without time
    "06-04-2020.csv": WITH_RATES + "\n"
        + "Texas,US,2020-06-05 02:33:06,100,1,1,1,,\n"
        + "Nowhere, ,2020-06-05 02:33:06,5,0,0,5,,\n"
        + "Quebec,Canada,2020-06-05 02:33:06,52143,4935,,,,\n"
        + ",Fiji,,18,0,18,0,,\n",
    # the row of the day before, still with its time: same key twice
    "06-05-2020.csv": WITH_RATES + "\nQuebec,Canada,2020-06-05 02:33:06,52398,4978,,,,\n",
}


def us_row(state, day, confirmed, deaths=0, tested=1000, rates=("10.5", "2.0", "500.5", "20.0", "1.5"), **more):
    incident, fatality, testing, hospital, mortality = rates
    country = more.get("country", "US")
    return (
        f"{state},{country},{day:%Y-%m-%d} 04:30:00,{more.get('lat', '31.1')},-99.3,{confirmed},{deaths},,,"
        f"{more.get('fips', '48.0')},{incident},{more.get('results', tested)},{tested},{more.get('hospital', '')},"
        f"{fatality},84000048,{more.get('iso3', 'USA')},{testing},{hospital},{mortality},{day:%Y-%m-%d}\n"
    )


def us_files() -> dict[str, str]:
    files: dict[str, list[str]] = {}

    def add(day, row):
        files.setdefault(f"{day:%m-%d-%Y}.csv", []).append(row)

    # the 14th is missing
    for day, texas, ohio in [(12, 100, 50), (13, 100, 60), (15, 130, 55)]:
        date = dt.date(2020, 4, day)
        add(date, us_row("Texas", date, texas, deaths=texas // 10))
        add(date, us_row("Ohio", date, ohio, deaths=5))
        add(date, us_row("Guam", date, 0, tested=0, rates=("", "", "", "", ""), country=" ", iso3="", lat="0.0"))
    for i in range(9):
        date = dt.date(2020, 5, 1) + dt.timedelta(days=i)
        add(date, us_row("Iowa", date, (i + 1) * 100, deaths=i, tested=10_000))
    for date, cases in [(dt.date(2022, 1, 1), 5000), (dt.date(2022, 12, 31), 9000)]:
        add(date, us_row("Utah", date, cases, tested=100_000))
    return {name: US_HEADER + "\n" + "".join(rows) for name, rows in files.items()}


def write_landing(root: Path) -> Path:
    for feed, files in {"global": GLOBAL_FILES, "us": us_files()}.items():
        (root / feed).mkdir(parents=True)
        for name, text in files.items():
            (root / feed / name).write_text(text, encoding="utf-8", newline="")
        (root / feed / "README.md").write_text("not a report")
    us = root / "us"
    (us / "bad.csv").write_bytes(b"\xff\xfe\x00broken\n1,2\n")
    (us / "04-20-2020.csv").write_text(US_HEADER + "\n" + us_row("Ohio", dt.date(2020, 4, 20), "many"))
    (us / "04-21-2020.csv").write_text(
        US_HEADER + "\n" + us_row("Ohio", dt.date(2020, 4, 21), 70).rstrip("\n") + ",surplus\n"
    )
    (us / "04-22-2020.csv").write_text("")
    (us / "04-23-2020.csv").write_text("a,b\n1,2\n")
    return root


# (file, left out, reason, column)
FAULTS = {
    ("bad.csv", "file", "no readable header", None),
    ("04-20-2020.csv", "row", "cell of the wrong type", "confirmed"),
    ("04-21-2020.csv", "row", "row longer than the header", None),
    ("04-22-2020.csv", "file", "empty file", None),
    ("04-23-2020.csv", "file", "header without any known column", None),
}
