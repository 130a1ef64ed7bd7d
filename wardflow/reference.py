"""Hospital admission tables: labels, bounds, personal columns.

Everything below is fixed values: results can only be right if these tables
are exactly the agreed ones. Operators receive them as arguments.
"""

from __future__ import annotations

# --- Raw columns, in file order (fixed values) -------------------------------
RAW_COLUMNS = [
    "id_admission", "id_patient", "nom_patient", "prenom_patient",
    "date_naissance", "age", "sexe", "telephone", "commune_residence",
    "assurance", "mode_admission", "date_entree", "date_sortie",
    "duree_sejour_j", "service", "pathologie", "gravite", "id_medecin",
    "temperature_entree_c", "cout_hospitalisation_fcfa", "issue",
]

# --- Columns of the prepared table, in order (fixed values) ------------------
PREPARED_COLUMNS = [
    "id_admission", "age", "sexe", "commune_residence", "assurance",
    "mode_admission", "date_entree", "date_sortie", "duree_sejour_j",
    "service", "pathologie", "gravite", "id_medecin", "temperature_entree_c",
    "cout_hospitalisation_fcfa", "issue", "duree_imputee",
    "id_patient_pseudo", "annee_naissance", "tranche_age", "mois", "saison",
    "categorie_pathologie", "cout_journalier_fcfa", "sejour_prolonge",
    "delai_readmission_j", "est_readmission_30j",
]

# --- Label tables (fixed values): normal form -> official label --------------
SEX_LABELS = {
    "m": "M", "masculin": "M", "h": "M", "homme": "M",
    "f": "F", "feminin": "F", "féminin": "F", "femme": "F",
}
UNKNOWN_M = "Non renseigné"
UNKNOWN_F = "Non renseignée"

DIAGNOSIS_LABELS = {
    "paludisme simple": "Paludisme simple",
    "paludisme grave": "Paludisme grave",
    "fievre typhoide": "Fièvre typhoïde",
    "gastro-enterite": "Gastro-entérite",
    "pneumopathie": "Pneumopathie",
    "infection respiratoire aigue": "Infection respiratoire aiguë",
    "tuberculose": "Tuberculose",
    "vih - infection opportuniste": "VIH – infection opportuniste",
    "hepatite virale b": "Hépatite virale B",
    "meningite": "Méningite",
    "covid-19": "Covid-19",
    "drepanocytose (crise)": "Drépanocytose (crise)",
    "anemie severe": "Anémie sévère",
    "hypertension arterielle": "Hypertension artérielle",
    "insuffisance cardiaque": "Insuffisance cardiaque",
    "avc ischemique": "AVC ischémique",
    "avc hemorragique": "AVC hémorragique",
    "diabete decompense": "Diabète décompensé",
    "insuffisance renale": "Insuffisance rénale",
    "epilepsie": "Épilepsie",
    "accouchement eutocique": "Accouchement eutocique",
    "cesarienne": "Césarienne",
    "pre-eclampsie": "Pré-éclampsie",
    "traumatisme routier": "Traumatisme routier",
    "fracture": "Fracture",
    "appendicite aigue": "Appendicite aiguë",
    "hernie etranglee": "Hernie étranglée",
    "occlusion intestinale": "Occlusion intestinale",
    "brulure": "Brûlure",
    "denutrition aigue": "Dénutrition aiguë",
    "prematurite": "Prématurité",
}

# Official diagnosis label -> analysis group.
DIAGNOSIS_GROUPS = {
    "Maladie infectieuse": [
        "Paludisme simple", "Paludisme grave", "Fièvre typhoïde",
        "Gastro-entérite", "Pneumopathie", "Infection respiratoire aiguë",
        "Tuberculose", "VIH – infection opportuniste", "Hépatite virale B",
        "Méningite", "Covid-19",
    ],
    "Maladie chronique non transmissible": [
        "Hypertension artérielle", "Insuffisance cardiaque", "AVC ischémique",
        "AVC hémorragique", "Diabète décompensé", "Insuffisance rénale",
        "Épilepsie", "Drépanocytose (crise)", "Anémie sévère",
    ],
    "Santé maternelle": [
        "Accouchement eutocique", "Césarienne", "Pré-eclampsie",
        "Pré-éclampsie",
    ],
    "Traumatologie et chirurgie": [
        "Traumatisme routier", "Fracture", "Appendicite aiguë",
        "Hernie étranglée", "Occlusion intestinale", "Brûlure",
    ],
    "Néonatalogie et nutrition": [
        "Prématurité", "Dénutrition aiguë",
    ],
}
OTHER_GROUP = "Autre"

SERVICE_LABELS = {
    "urgences": "Urgences",
    "pediatrie": "Pédiatrie",
    "medecine interne": "Médecine interne",
    "maternite": "Maternité",
    "chirurgie": "Chirurgie",
    "cardiologie": "Cardiologie",
    "neurologie": "Neurologie",
    "maladies infectieuses": "Maladies infectieuses",
}

# Beds declared per service; 1,445 in all.
SERVICE_BEDS = {
    "Urgences": 350, "Médecine interne": 270, "Pédiatrie": 220,
    "Chirurgie": 190, "Cardiologie": 140, "Neurologie": 110,
    "Maternité": 100, "Maladies infectieuses": 65,
}

TOWN_LABELS = {
    "abobo": "Abobo",
    "adjame": "Adjamé",
    "attecoube": "Attécoubé",
    "cocody": "Cocody",
    "koumassi": "Koumassi", "koumasi": "Koumassi",
    "marcory": "Marcory",
    "plateau": "Plateau",
    "port-bouet": "Port-Bouët", "port bouet": "Port-Bouët",
    "treichville": "Treichville", "treichvile": "Treichville",
    "yopougon": "Yopougon", "yopougn": "Yopougon",
    "bingerville": "Bingerville",
    "anyama": "Anyama",
    "songon": "Songon",
}

INSURANCE_LABELS = {
    "aucune": "Aucune", "cmu": "CMU",
    "mutuelle employeur": "Mutuelle employeur",
    "assurance privee": "Assurance privée",
}

# --- Bands and calendar (fixed values) ---------------------------------------
# (rank, label, lowest age, highest age)
AGE_BANDS = [
    (1, "0-4 ans (petite enfance)", 0, 4),
    (2, "5-14 ans (enfance)", 5, 14),
    (3, "15-24 ans (adolescence)", 15, 24),
    (4, "25-44 ans (adulte jeune)", 25, 44),
    (5, "45-64 ans (adulte)", 45, 64),
    (6, "65 ans et plus (âgé)", 65, 120),
]
AGE_UNKNOWN = "Âge non renseigné"

SEASON_BY_MONTH = {
    1: "Saison sèche", 2: "Saison sèche", 3: "Saison sèche",
    4: "Grande saison des pluies", 5: "Grande saison des pluies",
    6: "Grande saison des pluies", 7: "Grande saison des pluies",
    8: "Petite saison sèche", 9: "Petite saison sèche",
    10: "Petite saison des pluies", 11: "Petite saison des pluies",
    12: "Saison sèche",
}
MONTH_NAMES = {
    1: "janvier", 2: "février", 3: "mars", 4: "avril", 5: "mai", 6: "juin",
    7: "juillet", 8: "août", 9: "septembre", 10: "octobre",
    11: "novembre", 12: "décembre",
}
# Monday is 0.
DAY_NAMES = {
    0: "lundi", 1: "mardi", 2: "mercredi", 3: "jeudi",
    4: "vendredi", 5: "samedi", 6: "dimanche",
}

# --- Code lists (fixed values) -----------------------------------------------
OUTCOMES = ["Gueri", "Transfert", "Deces", "Sortie contre avis"]
DEATH = "Deces"
OUTCOME_NAMES = {
    "Gueri": "Guérison", "Transfert": "Transfert",
    "Deces": "Décès", "Sortie contre avis": "Sortie contre avis médical",
}
INSURANCES = ["Aucune", "CMU", "Mutuelle employeur", "Assurance privée"]
ADMISSION_MODES = ["Urgence", "Programmee", "Transfert"]
SEVERITIES = ["Legere", "Moderee", "Severe", "Critique"]
DOCTOR_UNKNOWN = "MED_INCONNU"

# --- Plausible range per column, both ends included (fixed values) -----------
BOUNDS = {
    "age": (0, 110),
    "duree_sejour_j": (0.1, 90),
    "temperature_entree_c": (30.0, 45.0),
    "cout_hospitalisation_fcfa": (1, 20_000_000),
}

# --- Personal data (fixed values) --------------------------------------------
DIRECT_IDENTIFIERS = ["nom_patient", "prenom_patient", "telephone"]
BIRTH_DATE = "date_naissance"
PATIENT_ID = "id_patient"
SALT_VARIABLE = "DE_SEL_PSEUDO"

# --- Tariff per service (fixed values): flat fee, daily rate -----------------
SERVICE_TARIFF = {
    "Urgences": (25_000, 18_000), "Pédiatrie": (15_000, 12_000),
    "Médecine interne": (20_000, 15_000), "Maternité": (45_000, 20_000),
    "Chirurgie": (150_000, 32_000), "Cardiologie": (60_000, 28_000),
    "Neurologie": (70_000, 30_000), "Maladies infectieuses": (25_000, 16_000),
}

# --- Wording of the journal (fixed values): step, detail ---------------------
JOURNAL = {
    "read": ("Extraction du fichier source", "{source}"),
    "duplicates": (
        "Suppression des doublons",
        "{exact} doublons stricts, {keys} id_admission dupliqués",
    ),
    "labels": ("Normalisation des libellés", "{unmatched} pathologies hors référentiel"),
    "types": ("Conversion des types", "dates, numériques, identifiants"),
    "outliers": ("Neutralisation des valeurs aberrantes", "{column}: {n}"),
    "dates": (
        "Correction des incohérences",
        "{inverted} chronologies inversées, {dated} durées reconstituées",
    ),
    "imputation": (
        "Imputation",
        "{imputed} durées (médiane par pathologie), "
        "{aged} âges recalculés depuis la date de naissance",
    ),
}

# --- Wording of the quality rules (fixed values): name, message --------------
RULES = {
    "unique": (
        "R1 — Unicité de id_admission",
        "{n} identifiants d'admission dupliqués : la clé primaire de la table de "
        "faits serait invalide.",
    ),
    "personal": (
        "R2 — Absence de données personnelles",
        "Des colonnes identifiantes subsistent : chargement interdit par la loi 2019-992.",
    ),
    "age": ("R3 — Âge dans une plage plausible", "{n} âges hors de l'intervalle [0 ; 110]."),
    "duration": (
        "R4 — Durée de séjour strictement positive",
        "{n} durées de séjour nulles, négatives ou manquantes.",
    ),
    "dates": (
        "R5 — Cohérence chronologique entrée/sortie",
        "{n} dates de sortie antérieures à la date d'entrée.",
    ),
    "outcome": ("R6 — Issue conforme au référentiel", "{n} valeurs d'issue hors référentiel."),
    "diagnosis": (
        "R7 — Pathologie rattachée au référentiel",
        "{n} admissions sans pathologie identifiée : elles seront exclues des "
        "analyses par diagnostic.",
    ),
    "temperature": (
        "R8 — Complétude de la température",
        "{n} températures non relevées ({n} dossiers incomplets).",
    ),
}

# --- Wording of the treatment audit (fixed values): operation, reason --------
TREATMENTS = {
    "hashed": (
        "Hachage SHA-256 salé", "Chaînage des séjours conservé sans identifiant direct",
    ),
    "dropped": ("Suppression", "Aucune valeur analytique (minimisation)"),
    "generalised": (
        "Généralisation (année seule)", "Quasi-identifiant : date exacte réidentifiante",
    ),
}
