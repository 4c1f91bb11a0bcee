"""Invented source files for whole runs."""

import json

from lutrin import values as V

TABLES = {
    "programmes": ("p.csv", "code;nom;discipline\nDROI;;D1\nMUSI;Chant;D2\nMUSI;;D3\nLANG;Latin;D2\n"),
    "programmes_laval": ("l.csv", "codeprogramme;code;nom;discipline\n900001;DROI;;D3\n"),
    "disciplines": (
        "d.csv",
        "discipline;bibliothecaire;bibliotheque\nD1;Lib A;B1\nD1;Lib B;B1\nD2;Lib C;B2\nD3;Lib D;B9\n",
    ),
    "secteurs": ("s.csv", "bibliotheque;secteur\nB1;S1\nB2;S2\n"),
    "unites": ("u.csv", "code;nom;discipline\nU1;Unité 1;D1\nU2;Unité 2;D2\n"),
    "_synonymes": (
        "y.tsv",
        "domaine\trejeter\taccepter\n"
        "Réservations\tBibliothèque B1\tB1\nRéservations\tBibliothèque B2\tB2\n"
        "Fréquentation\tb1\tB1\nFréquentation\tb1-annexe\tB1\nFréquentation\tb2\tB2\n"
        "Ordinateurs\tSalle B1\tB1\nOrdinateurs\tSalle B2\tB2\n"
        "Emprunts\tBibliothèque de l'exemple\tUniversité exemple\nEmprunts\tB1\tB1\nEmprunts\tannexe\tB1\n"
        "Emprunts\tBibliothèque extérieure\tBibliothèque extérieure\n",
    ),
    "_verif_cycles": ("c.csv", "cycle\n1\n2\n3\n4\n6\nC\n"),
    "_verif_statuts_reservations": ("v.csv", "nom,conserver\nConfirmed,1\nTentative,0\n"),
}


def write_lookups(folder):
    folder.mkdir(exist_ok=True)
    paths = {}
    for name, (file, text) in TABLES.items():
        (folder / file).write_text(text, encoding="utf8")
        paths[name] = str(folder / file)
    return paths


def line(layout, length, values):
    text = [" "] * length
    for (name, (start, end)), value in zip(layout.items(), values):
        assert len(value) <= end - start, name
        text[start : start + len(value)] = value
    return "".join(text)


def write_people(path, layout, length, people):
    path.parent.mkdir(exist_ok=True, parents=True)
    text = "\n".join(line(layout, length, p) for p in people)
    path.write_bytes(text.encode("ISO-8859-1"))
    return str(path)


def write_students(path, people):
    """People as (barcode, cycle, programme code, programme, mail, login)."""
    return write_people(path, V.STUDENT_LAYOUT, 600, people)


def write_staff(path, people):
    """People as (unit, unit name, status, mail, barcode, title, login)."""
    return write_people(path, V.STAFF_LAYOUT, 400, people)


def write_json(path, value):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf8")
    return str(path.parent)


def write_text(path, text):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_text(text, encoding="utf8")
    return str(path)


STUDENTS = [
    ("b1", "1DROI", "100000", "Droit civil", "p1@example.org", "etu1"),
    ("b2", "2MUSI", "100001", "Chant", "p2@example.org", "etu2"),
    ("b3", "CLANG", "100002", "Latin", "p3@example.org", "etu3"),
    ("b4", "3DROI", "900001", "Droit", "", "etu4"),
]
STAFF = [
    ("U1", "Unité 1", "R", "s1@example.org", "c1", "Professeur titulaire", "prof1"),
    ("U1", "Unité 1", "R", "s2@example.org", "c2", "Professeur clinicien", "prof2"),
    ("U2", "Unité 2", "C", "s3@example.org", "c3", "Chargé(e) de cours", "charge1"),
    ("UX", "Inconnue", "P", "s4@example.org", "c4", "Analyste", "pers1"),
    ("U1", "Unité 1", "T", "old@example.org", "c5", "Analyste", "double"),
    ("U2", "Unité 2", "T", "mid@example.org", "c6", "Analyste", "double"),
    ("U2", "Unité 2", "T", "new@example.org", "c7", "Analyste", "double"),
    ("U1", "Unité 1", "Q", "q@example.org", "c8", "Retraité", "retire"),
    ("U1", "Unité 1", "Z", "z@example.org", "c9", "Autre", "autre1"),
    ("U1", "Unité 1", "C", "p1@example.org", "c10", "Chargé(e) de cours", "etu1"),
]


def booking(n, mail, status="Confirmed", place="Bibliothèque B1", day="2024-01-10"):
    return {
        "fromDate": f"{day}T10:00:00-05:00", "email": mail, "status": status,
        "location_name": place, "category_name": "Salles", "item_name": f"A-{n}",
    }


def land_day(root):
    """All inputs of one day; returns their paths."""
    door = "Enregistrement,Secteur,Date,{}\n"
    return {
        "students": write_students(root / "ac.txt", STUDENTS),
        "staff": write_staff(root / "rh.txt", STAFF),
        "bookings": write_json(
            root / "bookings" / "page-1.json",
            [
                booking(1, "p1@example.org"),
                booking(2, "nobody@example.org", place="Bibliothèque B2"),
                booking(3, "s4@example.org"),
                booking(4, None),
                booking(5, "p1@example.org", status="Tentative"),
                booking(6, "p1@example.org", place="Bibliothèque de test"),
            ],
        ),
        "events": write_json(
            root / "events" / "events.json",
            {"events": [
                {"id": 7, "title": "Atelier", "start": "2024-01-10T10:00:00-05:00",
                 "end": "2024-01-10T11:00:00-05:00", "owner": {"id": 1, "name": "Org"}, "presenter": ""},
                {"id": 8, "title": "Essai", "start": "2024-01-10T10:00:00-05:00",
                 "end": "2024-01-10T11:00:00-05:00", "owner": {"id": 1, "name": "Org"}, "presenter": "Équipe TEST"},
                {"id": 9, "title": "Vide", "start": "2024-05-10T10:00:00-05:00",
                 "end": "2024-05-10T11:00:00-05:00", "owner": {"id": 1, "name": "Org"}, "presenter": "Ada"},
            ]},
        ),
        "registrations": write_json(
            root / "registrations" / "event-7.json",
            [{"registrants": [
                {"booking_id": 1, "registration_type": "x", "email": "p2@example.org"},
                {"booking_id": 2, "registration_type": "x", "email": "nobody@example.org"},
                {"booking_id": 3, "registration_type": "x", "email": None},
            ]}],
        ),
        "entries": write_text(
            root / "entries.csv",
            door.format("Entrees")
            + "1,b1,2024-01-10 08:00:00,5\n2,b1,2024-01-10 09:00:00,6\n3,b1-annexe,2024-01-10 09:00:00,1\n"
            "4,b2,2024-01-10 23:59:59,2\n5,b2,2024-01-11 00:00:00,9\n",
        ),
        "occupancy": write_text(
            root / "occupancy.csv",
            door.format("Occupation")
            + "1,b1,2024-01-10 08:00:00,3\n2,b1-annexe,2024-01-10 08:15:00,2\n3,b2,2024-01-10 08:00:00,-7\n"
            "4,b1,2024-01-20 08:00:00,40\n",
        ),
        "computers": write_text(
            root / "computers.csv",
            "ID,Secteur,Station,Login,Debut,Fin,Duree\n"
            "1,Salle B1,PC1,etu1,2024-01-10 08:00:00,2024-01-10 09:00:00,60\n"
            "2,Salle B2,PC2,invite,2024-01-10 08:00:00,2024-01-10 09:00:00,30\n"
            "3,Tests,PC3,etu1,2024-01-10 08:00:00,2024-01-10 09:00:00,30\n"
            "4,Salle B2,PC2,pers1,2024-01-10 10:00:00,2024-01-10 11:00:00,10\n",
        ),
        "loans": write_text(
            root / "loans.tsv",
            "\t".join(["doc", "cote", "pret", "usager", "Date/heure de l'évènement", "bib", "inst", "insu"])
            + "\n"
            + "\n".join(
                "\t".join(r)
                for r in [
                    ("d1", "QA1", "annexe", "b1", "10/1/2024 8:00:00", "B1", "Bibliothèque de l'exemple", "x"),
                    ("d1", "QA1", "annexe", "b1", "2024-01-10 08:00:00", "B1", "Bibliothèque de l'exemple", "x"),
                    ("d2", "QA2", "Ailleurs", "c3", "2024-01-10 09:00:00", "Loin", "Autre université", "x"),
                    ("d3", "QA3", "B1", "zzz", "2024-01-10 09:00:00", "B1", "Université exemple", "x"),
                    ("d4", "QA4", "B1", "b2", "n/a", "B1", "Université exemple", "x"),
                    ("d5", "QA5", "B1", "b2", "2024-01-10 09:00:00.5", "B1", "Université exemple", "x"),
                    ("d6", "QA6", "B1", "", "2024-01-10 09:00:00", "B1", "Université exemple", "x"),
                ]
            )
            + "\n",
        ),
    }
