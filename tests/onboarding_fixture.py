"""Three invented tenants with the quirks real ones have, and two rounds of their exports."""

import os

from ledgerloom.config import Tenant
from ledgerloom.sources.cells import CELL_SCHEMA

NORTH = {
    "tenant_id": "northwood",
    "timezone": "America/New_York",
    "feeds": {
        "buildings": {
            "contract": "buildings@1",
            "files": "Facilities*.csv",
            "columns": {
                "Bldg Code": "building_code", "Building Name": "building_name", "Type": "building_type",
                "Beds": "capacity", "Year Built": "year_built",
            },
            "values": {"building_type": {"Cabin": "cabin", "Dining Hall": "dining", "Camp Store": "store"}},
        },
        "assets": {
            "contract": "assets@2",
            "files": "Equipment*.xlsx",
            "format": {"type": "excel", "sheet": "Equipment", "header_row": 3},
            "columns": {
                "Tag #": "asset_tag", "Description": "asset_name", "System": "category",
                "Location": "building_code", "Purchased": "purchased_on", "Cost": "purchase_cost",
                "Condition": "status",
            },
            "values": {"category": {"Boats": "watercraft"}, "status": {"Good": "in_service"}},
        },
        "staff": {
            "contract": "staff@1",
            "files": "Roster*.csv",
            "columns": {
                "Employee ID": "staff_code", "First": "first_name", "Last": "last_name",
                "Position": "role", "Email": "email", "Start Date": "start_date", "Active?": "is_active",
            },
            "values": {"role": {"Nurse": "health"}},
            "parse": {"date_formats": ["%m/%d/%Y"]},
        },
        "commissary_transactions": {
            "contract": "commissary_transactions@1",
            "files": "POS*.csv",
            "columns": {
                "Receipt #": "transaction_id", "Line": "line_number", "Date/Time": "sold_at",
                "Store": "store_building_code", "Cashier": "cashier_staff_code", "SKU": "sku",
                "Item": "item_name", "Category": "item_category", "Qty": "quantity", "Price": "unit_price",
                "Tender": "payment_method",
            },
            "values": {"payment_method": {"Camp Account": "camper_account"}},
            "parse": {"timestamp_formats": ["%m/%d/%Y %I:%M %p"]},
        },
    },
}

FLEUVE = {
    "tenant_id": "fleuve",
    "timezone": "America/Toronto",
    "defaults": {
        "format": {"type": "csv", "encoding": "latin-1", "delimiter": ";"},
        "parse": {
            "date_formats": ["%d/%m/%Y"], "timestamp_formats": ["%d/%m/%Y %H:%M"], "decimal_separator": ",",
        },
    },
    "feeds": {
        "buildings": {
            "contract": "buildings@1",
            "files": "batiments*.csv",
            "columns": {
                "Code du bâtiment": "building_code", "Nom": "building_name", "Genre": "building_type",
                "Capacité": "capacity",
            },
            "values": {"building_type": {"Salle à manger": "dining", "Chalet": "cabin"}},
        },
        "assets": {
            "contract": "assets@1",
            "files": "equipements*.csv",
            "columns": {
                "No": "asset_tag", "Description": "asset_name", "Bâtiment": "building_code",
                "Date d'achat": "purchased_on", "Prix": "purchase_price",
            },
        },
    },
}

TENANTS = [Tenant.from_dict(NORTH), Tenant.from_dict(FLEUVE)]

BUILDINGS_HEAD = "Bldg Code, building  NAME ,Type,Beds,Year Built,Notes\n"
STAFF_HEAD = "Employee ID,First,Last,Position,Email,Start Date,Active?\n"
POS_HEAD = "Receipt #,Line,Date/Time,Store,Cashier,SKU,Item,Category,Qty,Price,Tender\n"

ROUND_1 = {
    "northwood/Facilities 1.csv": (
        BUILDINGS_HEAD
        + "NW-1,Birch,cabin,12,1970,x\n"
        + "NW-2,,Cabin,8,1980,\n"
        + "\n"
        + "NW-3,Oak,Yurt,8,1980,\n"
        + "NW-4,Store,camp   store,0,1990,\n"
        + "NW-1,Birch again,Cabin,12,1970,\n",
        "utf-8",
    ),
    "northwood/Roster.csv": (
        STAFF_HEAD
        + "S-01,Ann,Lee,Nurse,ann@x.org,06/01/2024,Y\n"
        + "S-02,Bob,Roy,admin,bob@,06/01/2024,N\n"
        + "S-03,Cy,Fox,admin,,,N\n",
        "utf-8",
    ),
    "northwood/POS week1.csv": (
        POS_HEAD
        + "R1,1,07/04/2024 02:30 PM,NW-4,S-01,K1,Soda,drink,2,$1.50,Camp Account\n"
        + "R1,2,07/04/2024 02:30 PM,OLD,S-01,K2,Chips,snack,0,free,cash\n",
        "utf-8",
    ),
    "northwood/POS week2.csv": (
        "Receipt #,Line,Date/Time,Store,Cashier,SKU,Item,Category,Qty,Price\n"
        + "R2,1,07/05/2024 02:30 PM,NW-4,,K1,Soda,drink,2,1.50\n",
        "utf-8",
    ),
    "northwood/POS empty.csv": ("\n\n", "utf-8"),
    "fleuve/batiments.csv": (
        "Code du bâtiment;Nom;Genre;Capacité\n"
        + "FL-1;Érables;Chalet;1 2\n\nFL-2;;SALLE À MANGER;40\n",
        "latin-1",
    ),
    "fleuve/equipements.csv": (
        "No;Description;Bâtiment;Date d'achat;Prix\n"
        + "EQ-1;Canot;FL-1;04/07/2020;1 450,50\n"
        + "EQ-2;Kayak;FL-2;04/07/2020;10,00\n"
        + "EQ-3;Rame;ZZ-9;bientôt;-5,00\n"
        + ";Sans numéro;FL-1;;\n",
        "latin-1",
    ),
}

ROUND_2 = {
    "northwood/Facilities 2.csv": (
        BUILDINGS_HEAD.replace(",Notes", "")
        + "NW-1,Birch,cabin,12,1970\nNW-2,Elm,Cabin,8,1980\nNW-3,Oak,Cabin,8,1980\nNW-4,Store,store,0,1990\n",
        "utf-8",
    ),
    "northwood/Roster 2.csv": (
        STAFF_HEAD
        + "S-02,Bob,Roy,admin,bob@x.org,06/01/2024,N\nS-03,Cy,Fox,admin,,06/02/2024,N\n",
        "utf-8",
    ),
    "northwood/POS week3.csv": (
        POS_HEAD
        + "R1,1,07/04/2024 02:30 PM,NW-4,S-01,K1,Soda,drink,2,$1.50,Camp Account\n"
        + "R1,2,07/04/2024 02:30 PM,NW-4,S-01,K2,Chips,snack,1,2.00,cash\n"
        + "R2,1,07/05/2024 02:30 PM,NW-4,,K1,Soda,drink,2,1.50,card\n",
        "utf-8",
    ),
    "fleuve/batiments 2.csv": (
        "Code du bâtiment;Nom;Genre;Capacité\nFL-1;Érables;Chalet;12\nFL-2;Salle;Salle à manger;40\n",
        "latin-1",
    ),
    "fleuve/equipements 2.csv": (
        "No;Description;Bâtiment;Date d'achat;Prix\n"
        + "EQ-2;Kayak;FL-2;04/07/2020;10,00\nEQ-3;Rame;FL-1;;5,00\nEQ-4;Pagaie;FL-1;;\n",
        "latin-1",
    ),
}

SHEET = [
    [("text", "Camp: equipment")],
    [("text", "Exported June 1")],
    [("text", t) for t in ("Tag #", "Description", "System", "Location", "Purchased", "Cost", "Condition")],
    [
        ("text", "T-0001"), ("text", "Canoe"), ("text", "boats"), ("text", "NW-1"),
        ("datetime", "2020-07-04 00:00:00"), ("float", "1200.5"), ("text", "Good"),
    ],
    [(None, None)],
    [
        ("text", "T-0002"), ("text", "Stove"), ("text", "kitchen"), ("text", "NW-2"),
        ("int", "44016"), ("int", "-150"), ("text", "Good"),
    ],
    [
        ("text", "T-0003"), ("int", "101"), ("text", "Pool Stuff"), ("text", "NW-1"),
        ("int", "5"), (None, None), ("text", "Down"),
    ],
]


def write(landing, files, start):
    for i, (name, (text, encoding)) in enumerate(files.items()):
        path = landing / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode(encoding))
        os.utime(path, (start + i, start + i))


def write_sheet(spark, landing, start):
    """A placeholder workbook for discovery and the cells it holds."""
    path = landing / "northwood" / "Equipment.xlsx"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"workbook")
    os.utime(path, (start, start))
    cells = [
        (str(path), "Equipment", 0, n, c, kind, text)
        for n, row in enumerate(SHEET, 1)
        for c, (kind, text) in enumerate(row)
    ]
    return spark.createDataFrame(cells, CELL_SCHEMA)
