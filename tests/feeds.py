"""Hand-written daily feeds with invented people: two header forms, two days."""

from __future__ import annotations

import zipfile
from pathlib import Path

TAIL = [
    "Customer_Segment", "Maritial_Status", "Gender", "DOB", "Effective_Start_Dt", "Effective_End_Dt", "Policy_Type_Id",
    "Policy_Type", "Policy_Type_Desc", "Policy_Id", "Policy_Name", "Premium_Amt", "Policy_Term", "Policy_Start_Dt",
    "Policy_End_Dt", "Next_Premium_Dt", "Actual_Premium_Paid_Dt", "Country", "Region", "State or Province", "City",
    "Postal Code", "Total_Policy_Amt", "Premium_Amt_Paid_TillDate",
]
PARTS = ["Customer ID", "Customer Title", "Customer First Name", "Customer Middle Name", "Customer Last Name"]
DRIFTED = [*PARTS[:4], "Customer Last name"]
WHOLE = ["Customer ID", "Customer Name"]


def line(who, status, kind, policy, start, due, paid, country, region, postal, premium="5000", segment="Corporate") -> list[str]:
    return [
        *who, segment, status, "Male", "7/9/1980", "5/31/2011", "", kind, f"Kind{kind}", f"About {kind}", policy,
        f"Plan {kind}", premium, "Quarterly", start, "1/1/2101", due, paid, country, region, f"{region} State", "Town",
        postal, "500000", "60000",
    ]


DAY1_CENTRAL = [
    line(["1", "Mr.", "ANNA", "", "o'hara"], "Single", "10", "10_1", "11/20/2008", "3/10/2013", "9/4/2013", "US", "Central", "01234"),
    line([" 2 ", "Mrs.", "bea", "q", "Lund"], "Married", "10", "10_1", "11/20/2008", "3/10/2013", "3/20/2013", "U.S.A", "Central", "65210"),
]
DAY1_EAST = [
    line(["3", "cARL dOE"], "Single", "11", "11_1", "1/5/2012", "4/5/2013", "10/6/2013", "United States", "East", "10001", "$6,000"),
    line(["4", "Dora Fox"], "Divorced", "11", "11_2", "1/6/2012", "4/5/2013", "3/1/2013", "usa", "East", "10002"),
]
# Customer 1 marries and moves, 2 is as before, 3 is missing, 4 changes the segment, 5 is new.
DAY2_CENTRAL = [
    line(["1", "Mr.", "ANNA", "", "o'hara"], "Married", "10", "10_1", "11/20/2008", "6/25/2013", "2/10/2014", "US", "Central", "65299"),
    line(["2", "Mrs.", "bea", "q", "Lund"], "Married", "12", "12_1", "2/2/2013", "6/25/2013", "7/5/2013", "USA", "Central", "65210"),
]
DAY2_EAST = [
    line(["4", "Dora Fox"], "Divorced", "11", "11_2", "2/6/2013", "7/5/2013", "8/4/2014", "N/A", "East", "10002", "5000", "Consumer"),
    line(["5", "Edgar, Jr."], "Single", "11", "11_1", "1/5/2012", "7/5/2013", "7/20/2013", "US", "East", "10003"),
]


def text(header: list[str], lines: list[list[str]]) -> str:
    cells = [[f'"{c}"' if "," in c else c for c in row] for row in [header, *lines]]
    return "\n".join(",".join(row) for row in cells) + "\n"


FILES = {
    "Feed_Central_day1.csv": text([*PARTS, *TAIL], DAY1_CENTRAL),
    "Feed_East_day1.csv": text([*WHOLE, *TAIL], DAY1_EAST),
    "Feed_Central_day2.csv": text([*DRIFTED, *TAIL], DAY2_CENTRAL),
    "Feed_East_day2.csv": text([*WHOLE, *TAIL], DAY2_EAST),
}


def write(folder: Path, names: list[str] | None = None) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for name in names or FILES:
        (folder / name).write_text(FILES[name])
    return str(folder)


def write_zip(folder: Path, archive: str, members: dict[str, str]) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / archive, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return str(folder)
