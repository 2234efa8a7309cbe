"""Hand-made places and offers with invented names."""

from __future__ import annotations

import datetime as dt

from jobscape import schemas

COMMUNES = [
    # nom, code, departement, siren, epci, region, postal codes, population
    ("Lyonville", "C1", "01", None, "E1", "R1", ["10002", "10001"], 500),
    ("Lyonville", "C1", "01", None, "E1", "R1", ["10002", "10001"], 500),
    ("Saint-Mir", "C2", "01", None, None, "R1", ["10100"], 20),
    ("Saint-Mir", "C3", "02", None, "E2", "R1", ["20100"], 30),
    ("Videcourt", "C4", "02", None, "E2", "R1", [], 5),
    ("Nullbourg", "C5", "02", None, "E2", "R1", None, None),
    ("Éloi", "C6", "99", None, "E2", "R1", ["99100"], 7),
]


def place_lists(spark):
    return [
        spark.createDataFrame(COMMUNES, schemas.COMMUNES),
        spark.createDataFrame([("Ainval", "01", "R1"), ("Basmont", "02", "R1")], schemas.DEPARTMENTS),
        spark.createDataFrame([("Norderie", "R1")], schemas.REGIONS),
        spark.createDataFrame([("Métropole A", "E1", None, None, None), ("CC B", "E2", None, None, None)], schemas.EPCIS),
    ]


def coded_offers(spark):
    created = dt.datetime(2026, 4, 6, 9, 58, 27)
    layout = schemas.struct_of(schemas.CODED_OFFERS)
    offers = [
        ("O1", "Data engineer", " C1 ", "35 k"),
        ("O2", "Alternance data", "C2", None),
        ("O3", None, "  ", "x"),
        ("O4", "Dev", None, None),
        ("O5", "Dev", "C4", ""),
        ("O6", "Archi", "ZZ", "1"),
        ("O7", "contrat en ALTERNANCE", "C6", "  "),
    ]

    def record(offer):
        ident, title, commune, salary = offer
        values = dict.fromkeys(layout.names)
        values.update(
            id=ident,
            intitule=title,
            dateCreation=created,
            lieuTravail=("lieu", None, None, "00000", commune),
            salaire=(salary, None, None, None, None),
            entreprise=(" Acmé ", None, None, None, None),
        )
        return tuple(values[n] for n in layout.names)

    return spark.createDataFrame([record(o) for o in offers], layout)


def named_offers(spark):
    layout = schemas.struct_of(schemas.NAMED_OFFERS)
    offers = [
        ("A1", ["France", "Norderie", "Ainval", "Lyonville"], 10.0, None),
        ("A1", ["France", "Norderie", "Ainval", "Lyonville"], 10.0, None),
        ("A2", ["France", "Saint-Mir"], None, None),
        ("A3", ["France"], 1.0, 2.0),
        ("A4", ["France", "N", "basmont", "SAINT-MIR"], None, 5.0),
        ("A5", None, None, None),
        ("A6", ["France", "Basmont", "Lyonville"], None, None),
        ("A7", ["France", "Éloi"], None, None),
        ("A8", ["France", "Ainval", "Lyonville", "Saint-Mir"], None, None),
    ]

    def record(offer):
        ident, area, low, high = offer
        values = dict.fromkeys(layout.names)
        label = ", ".join(reversed(area[-2:])) if area else None
        values.update(id=ident, title="t", salary_min=low, salary_max=high, location=(label, area))
        return tuple(values[n] for n in layout.names)

    return spark.createDataFrame([record(o) for o in offers], layout)
