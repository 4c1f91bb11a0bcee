"""The table contract: columns, types, text lengths and keys of every table.

Surrogate row numbers are left out: nothing refers to them, and numbering rows
in order would need all of them in one place. The one exception, the file order
of staff rows, is made by the scan (`sources.fixed_width`).
"""

from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LENGTH = "max_length"

_TYPES = {
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "instant": T.TimestampNTZType(),
    "flag": T.BooleanType(),
    "share": T.DecimalType(21, 20),
    "weighted": T.DecimalType(34, 20),
}


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: tuple = ()
    loaded: tuple = ()  # columns of the landed file, in its order
    sep: str = ","


def _column(text):
    name, kind = text.split(":")
    if kind.isdigit():
        return T.StructField(name, T.StringType(), True, {MAX_LENGTH: int(kind)})
    return T.StructField(name, _TYPES[kind])


def _table(name, columns, key="", loaded="", sep=","):
    return Table(
        name,
        T.StructType([_column(c) for c in columns.split()]),
        tuple(key.split()),
        tuple(loaded.split()),
        sep,
    )


# Table and column names, types, lengths, keys and file layouts.
_ALL = [
    _table(
        "programmes",
        "code:50 nom:255 discipline:255",
        loaded="code nom discipline",
        sep=";",
    ),
    _table(
        "programmes_laval",
        "codeprogramme:50 code:50 nom:255 discipline:255",
        loaded="codeprogramme code nom discipline",
        sep=";",
    ),
    _table(
        "secteurs",
        "bibliotheque:100 secteur:100",
        key="bibliotheque",
        loaded="bibliotheque secteur",
        sep=";",
    ),
    _table(
        "disciplines",
        "discipline:255 bibliothecaire:255 bibliotheque:255 secteur:255 facteur:share",
        key="discipline bibliothecaire",
        loaded="discipline bibliothecaire bibliotheque",
        sep=";",
    ),
    _table(
        "unites",
        "code:255 nom:255 discipline:255",
        key="code",
        loaded="code nom discipline",
        sep=";",
    ),
    _table("_verif_cycles", "cycle:255", key="cycle", loaded="cycle", sep=";"),
    _table(
        "_verif_statuts_reservations",
        "nom:255 conserver:flag",
        key="nom",
        loaded="nom conserver",
    ),
    _table(
        "_synonymes",
        "domaine:255 rejeter:255 accepter:255",
        key="domaine rejeter",
        loaded="domaine rejeter accepter",
        sep="\t",
    ),
    _table(
        "_tmp_reservations",
        "fromDate:instant email:255 status:255 location_name:255 category_name:255 item_name:255",
        loaded="fromDate email status location_name category_name item_name",
    ),
    _table(
        "reservations",
        "usager:255 courriel:255 discipline:255 journee:date session:date bibliotheque:255"
        " categorie:255 salle:255",
    ),
    _table(
        "_tmp_inscriptions",
        "event_id:50 booking_id:50 registration_type:255 email:255",
        key="event_id booking_id",
        loaded="event_id booking_id registration_type email",
    ),
    _table(
        "inscriptions",
        "id:50 usager:255 courriel:255 discipline:255 evenement_id:50",
        key="id evenement_id",
    ),
    _table(
        "_tmp_evenements",
        "id:50 title:255 start:instant finish:instant owner:255 presenter:255",
        key="id",
        loaded="id title start finish owner presenter",
    ),
    _table(
        "evenements",
        "id:50 titre:255 journee:date session:date proprietaire:255 presentateur:255"
        " nb_participants:bigint",
        key="id",
    ),
    _table(
        "_tmp_sessions_ordinateurs",
        "ID:integer Secteur:100 Station:100 Utilisateur_Login:255 Ouverture_session:instant"
        " Fermeture_session:instant Duree:integer",
        key="ID",
        loaded="ID Secteur Station Utilisateur_Login Ouverture_session Fermeture_session Duree",
    ),
    _table(
        "sessions_ordinateurs",
        "usager:255 courriel:255 discipline:255 bibliotheque:255 session:date journee:date"
        " dateheure:instant lieu:255 ordinateur:255 duree:integer",
        key="usager ordinateur dateheure",
    ),
    _table(
        "_tmp_frequentation",
        "Enregistrement:integer Secteur:100 Date:instant Entrees:integer",
        key="Enregistrement",
        loaded="Enregistrement Secteur Date Entrees",
    ),
    _table(
        "_tmp_occupation",
        "Enregistrement:integer Secteur:100 Date:instant Occupation:integer",
        key="Enregistrement",
        loaded="Enregistrement Secteur Date Occupation",
    ),
    _table(
        "frequentation",
        "journee:date session:date bibliotheque:100 frequentation:bigint occupation:bigint",
        key="journee bibliotheque",
    ),
    _table(
        "_tmp_etudiants",
        "codebarres:50 codeCycle:10 codeProgramme:10 programme:255 courriel:100 login:100"
        " journee:date",
        key="journee login",
        loaded="codebarres codeCycle codeProgramme programme courriel login",
    ),
    _table(
        "_tmp_personnel",
        "id:bigint CodeUnite:10 DescUnite:255 Statut:5 Courriel:255 CodeBarres:50 Fonction:255"
        " Login:100 journee:date",
        key="id",
        loaded="CodeUnite DescUnite Statut Courriel CodeBarres Fonction Login",
    ),
    _table(
        "_clientele_cumul",
        "journee:date usager:255 courriel:255 codebarres:255 fonction:50 niveau:50 session:255"
        " code_programme:10 programme:255 code_unite:10 unite:255 discipline:255"
        " bibliotheque:100 clientele:flag",
        key="journee usager",
    ),
    _table(
        "clientele",
        "journee:date usager:255 courriel:255 codebarres:255 fonction:50 niveau:50 session:255"
        " code_programme:10 programme:255 code_unite:10 unite:255 discipline:255"
        " bibliotheque:100",
        key="journee usager",
    ),
    _table(
        "disciplines_stats",
        "discipline:255 bibliothecaire:255 bibliotheque:255 secteur:255 fonction:255 niveau:255"
        " session:255 nb_personnes:weighted",
        key="discipline bibliothecaire fonction niveau session",
    ),
    _table(
        "_tmp_emprunts",
        "cb_document:255 cote:255 bibliotheque_pret:255 cb_usager:255 date:255"
        " bibliotheque_document:255 institution_doc:255 institution_usager:255",
        loaded="cb_document cote bibliotheque_pret cb_usager date bibliotheque_document"
        " institution_doc institution_usager",
        sep="\t",
    ),
    _table(
        "emprunts",
        "cb_document:255 cote:255 bibliotheque_pret:255 cb_usager:255 usager:255 courriel:255"
        " discipline:255 session:date journee:date dateheure:instant bibliotheque_document:255"
        " institution_doc:255 institution_usager:255",
        key="cb_document cb_usager dateheure",
    ),
]

TABLES = {t.name: t for t in _ALL}

# Side tables of this library, beside the contract: days on which an account's sessions lack a
# person; what links to a person needs, by mail address and by barcode; people counted per
# snapshot; files that a backfill has loaded.
_LINKED = "journee:date usager:255 courriel:255 codebarres:255 discipline:255"
SIDE_TABLES = {
    t.name: t
    for t in [
        _table("_sessions_en_attente", "usager:255 journee:date", key="usager journee"),
        _table("_clientele_par_courriel", _LINKED, key="courriel usager"),
        _table("_clientele_par_codebarres", _LINKED, key="codebarres usager"),
        _table(
            "_clientele_comptes",
            "journee:date discipline:255 fonction:50 niveau:50 session:255 nb:bigint",
        ),
        _table(
            "_fichiers_charges",
            "chemin:4000 taille:bigint modifie:instant journee:date raison:255",
            key="chemin",
        ),
    ]
}
WAITING = "_sessions_en_attente"
COUNTS = "_clientele_comptes"
LEDGER = "_fichiers_charges"
PEOPLE = "_clientele_cumul"
# Copies of the person table by link key.
LINKS = {"_clientele_par_courriel": "courriel", "_clientele_par_codebarres": "codebarres"}

# Tables that belong to each domain, to create or check one domain at a time.
DOMAINS = {
    "programmes": ("programmes",),
    "programmes_laval": ("programmes_laval",),
    "secteurs": ("secteurs",),
    "disciplines": ("disciplines",),
    "unites": ("unites",),
    "verifications": ("_verif_cycles", "_verif_statuts_reservations"),
    "synonymes": ("_synonymes",),
    "reservations": ("_tmp_reservations", "reservations"),
    "inscriptions": ("_tmp_inscriptions", "inscriptions"),
    "evenements": ("_tmp_evenements", "evenements"),
    "ordinateurs": ("_tmp_sessions_ordinateurs", "sessions_ordinateurs"),
    "frequentation": ("_tmp_frequentation", "_tmp_occupation", "frequentation"),
    "people": ("_tmp_etudiants", "_tmp_personnel", "_clientele_cumul", "clientele"),
    "statistics": ("disciplines_stats",),
    "emprunts": ("_tmp_emprunts", "emprunts"),
}


def table(name):
    return TABLES[name]


def spec(name):
    """A table of the contract or a side table."""
    return SIDE_TABLES.get(name) or TABLES[name]


def empty_table(spark, name):
    return spark.createDataFrame([], spec(name).schema)


def conform(df, name):
    """Select the columns of a table in their order and types; missing ones are NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (
                F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)
            ).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in spec(name).schema.fields
        ]
    )
