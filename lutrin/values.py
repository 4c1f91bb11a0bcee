"""Labels, names and layouts that the warehouse data must carry as they are."""

# First character of a cycle code -> level.
CYCLE_LEVELS = {
    "1": "Étudiant - 1er cycle",
    "2": "Étudiant - 2e cycle",
    "3": "Étudiant - 3e cycle",
    "4": "Postdoctorat",
    "6": "Étudiant - Médecine 3e cycle",
    "C": "Étudiant - Certificat",
}

# Functions of people.
STUDENT = "Étudiant"
LECTURER = "Chargé de cours"
PROFESSOR = "Professeur"
EMPLOYEE = "Personnel"

# Staff statuses.
RETIRED_STATUSES = ("Q", "X")
EMPLOYEE_STATUSES = ("P", "T")
LECTURER_STATUS = "C"
PROFESSOR_STATUS = "R"

# Job titles that make a lecturer or a professor part of the audience.
LECTURER_TITLE = "Chargé(e) de cours"
RESEARCHER_TITLE_START = "Chercheur"
TEACHER_TITLE_START = "Enseignant"
PROFESSOR_TITLE_START = "Prof"
CLINICAL_TITLE_PART = "clini"

# Names used in place of missing or outside ones.
UNKNOWN_DISCIPLINE = "Inconnue"
OUTSIDE_LIBRARY = "Bibliothèque extérieure"

# Domains of the synonym table.
BOOKINGS = "Réservations"
TRAFFIC = "Fréquentation"
COMPUTERS = "Ordinateurs"
LOANS = "Emprunts"

# Booking locations that only serve tests and training.
TEST_LOCATIONS = ("Bibliothèque de test", "Bibliothèque de formation")

# Text that marks a test sector or a test presenter.
TEST_SECTOR_PART = "Tests"
TEST_PRESENTER_PART = "Test"

# Fields of the fixed-width people files, 0-based, end excluded.
STUDENT_LAYOUT = {
    "codebarres": (11, 25),
    "codeCycle": (423, 428),
    "codeProgramme": (458, 464),
    "programme": (468, 498),
    "courriel": (498, 567),
    "login": (568, 598),
}
STAFF_LAYOUT = {
    "CodeUnite": (214, 221),
    "DescUnite": (175, 214),
    "Statut": (221, 222),
    "Courriel": (222, 302),
    "CodeBarres": (302, 316),
    "Fonction": (361, 391),
    "Login": (391, 399),
}
PEOPLE_ENCODING = "ISO-8859-1"

# Start of the names of the daily people files.
STUDENT_FILE_START = "synchro_ac"
STAFF_FILE_START = "synchro_rh"

# Header of the loan date, and its name in the warehouse.
LOAN_DATE_HEADER = "Date/heure de l'évènement"
LOAN_DATE = "date"

# JSON fields kept from each interface.
BOOKING_FIELDS = ("fromDate", "email", "status", "location_name", "category_name", "item_name")
EVENT_FIELDS = ("id", "title", "start", "end", "owner.name", "presenter")
REGISTRATION_FIELDS = ("event_id", "booking_id", "registration_type", "email")
DESK_FIELDS = ("transaction_id", "created", "owner")
DESK_LABELS = ("Unités", "Localisation", "Type d'intervention", "Modalité")

# Rows per page of the booking interface, days per event request.
BOOKING_PAGE = 100
EVENT_ANSWER = 500
EVENT_CHUNK_DAYS = 10
