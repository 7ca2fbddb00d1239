"""Fixed values of the incident data model.

Everything in this module is data, not logic. The entries have to stay exactly
as they are for results to agree with existing incident tables; the order of
TEXT_REPAIR and of each synonym list is part of the data.
"""

# --- fixed values: expected raw columns, in output order -------------------
EXPECTED_COLUMNS = [
    "NUMERO_INCIDENTE",
    "FECHA_INICIO_DESPLAZAMIENTO_MOVIL",
    "CODIGO_LOCALIDAD",
    "LOCALIDAD",
    "EDAD",
    "UNIDAD",
    "GENERO",
    "TIPO_INCIDENTE",
    "PRIORIDAD_FINAL",
    "RECEPCION",
]

# --- fixed values: header synonyms, first present one wins -----------------
COLUMN_SYNONYMS = {
    "NUMERO_INCIDENTE": ["NUMERO_INCIDENTE"],
    "FECHA_INICIO_DESPLAZAMIENTO_MOVIL": [
        "FECHA_INICIO_DESPLAZAMIENTO_MOVIL",
        "FECHA_INICIO_DESPLAZAMIENTO_MOVIL.1",
        "FECHA_INICIO_DESPLAZAMIENTO_MOVIl",
        "FECHA_INICIO_DESPLAZAMIENTO_MOVIl.1",
        "FECHA_INICIO_DESPLAZAMIENTO-MOVIL",
        "FECHA_DESPACHO_518",
    ],
    "PRIORIDAD_FINAL": ["PRIORIDAD_FINAL", "PRIORIDAD FINAL", "PRIORIDAD"],
    "CODIGO_LOCALIDAD": ["CODIGO_LOCALIDAD", "CODIGO DE LOCALIDAD", "COD_LOCALIDAD"],
}

# --- fixed values: text repair, 28 sequences then 16 single characters -----
TEXT_REPAIR = {
    "Ã¡": "á",
    "Ã©": "é",
    "Ã\u00ad": "í",
    "Ã³": "ó",
    "ÃÁ": "Á",
    "Ã‰": "É",
    "ÃÍ": "Í",
    "Ã“": "Ó",
    "Ãš": "Ú",
    "Ã±": "ñ",
    "Ã‘": "Ñ",
    "Ã¼": "ü",
    "Ãœ": "Ü",
    "Â¿": "¿",
    "Â¡": "¡",
    "Â°": "°",
    "Âª": "ª",
    "Âº": "º",
    "â€“": "–",
    "â€”": "—",
    "â€˜": "‘",
    "â€™": "’",
    "â€œ": "“",
    "â€\u009d": "”",
    "â€¢": "•",
    "â€¦": "…",
    "Ã·": "I",
    "Â§": "§",
    "÷": "I",
    "µ": "A",
    "•": "N",
    "‡": "O",
    "§": "ñ",
    "ê": "E",
    "?": "I",
    "¢": "N",
    "ù": "ñ",
    "¤": "n",
    "¥": "N",
    "à": "O",
    "Ö": "O",
    "\u0082": "e",
    "¡": "I",
    "\u00a0": "A",
}

# --- fixed values: cells that count as missing when a CSV is read ----------
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- fixed values: null-like words, compared in lower case after trimming --
NULL_WORDS = ["", "nan", "none", "null"]
TIMESTAMP_NULL_WORDS = ["", "nat", "nan", "none", "null"]

# --- fixed values: label dictionary (None marks "no value") ----------------
LABELS = {
    "ANOS": "AÑOS",
    "AÑOS": "AÑOS",
    "AÇÑOS": "AÑOS",
    "SIN_DATO": None,
    "NAN": None,
    "CONVULSINN": "CONVULSION",
    "CONVULSIÓN": "CONVULSION",
    "INTOXICACINN": "INTOXICACION",
    "INTOXICACIÓN": "INTOXICACION",
    "ELECTROCUCINN / RESCATE": "ELECTROCUCION / RESCATE",
    "ELECTROCUCIÓN / RESCATE": "ELECTROCUCION / RESCATE",
    "ACCIDENTE DE AVIACINN": "ACCIDENTE DE AVIACION",
    "DOLOR TORAXCICO": "DOLOR TORACICO",
    "DOLOR TORÁCICO": "DOLOR TORACICO",
    "DOLOR TOR CICO": "DOLOR TORACICO",
    "PATOLOGÍA GINECOBSTÉTRICA": "PATOLOGIA GINECOBSTETRICA",
    "PATOLOGOA GINECOBST\u0090TRICA": "PATOLOGIA GINECOBSTETRICA",
    "SÍNTOMAS GASTROINTESTINALES": "SINTOMAS GASTROINTESTINALES",
    "CAÍDA DE ALTURA": "CAIDA DE ALTURA",
    "CAODA DE ALTURA": "CAIDA DE ALTURA",
    "ACOMPAÑAMIENTO EVENTO": "ACOMPANAMIENTO EVENTO",
    "ACOEVE": "ACV",
    "CRITCA": "CRITICA",
    "ENGATIVAX": "ENGATIVA",
    "ENGATIVÁ": "ENGATIVA",
    "ENGATIV": "ENGATIVA",
    "SAN CRISTNBAL": "SAN CRISTOBAL",
    "FONTIBNN": "FONTIBON",
    "LOS MAXRTIRES": "LOS MARTIRES",
    "FONTIBÓN": "FONTIBON",
    "USAQUÉN": "USAQUEN",
    "CIUDAD BOLÍVAR": "CIUDAD BOLIVAR",
    "LOS MÁRTIRES": "LOS MARTIRES",
    "SAN CRISTÓBAL": "SAN CRISTOBAL",
    "ANTONIO NARIÑO": "ANTONIO NARINO",
    "LOS M RTIRES": "LOS MARTIRES",
    "M": "MASCULINO",
    "F": "FEMENINO",
    "608": "HERIDO",
    "603": "CONVULSION",
    "601": "ACV",
    "924": "ENFERMO",
    "609": "AMESUI",
    "613": "INCONSCIENTE",
    "604": "EVERES",
    "941": "TRASTMENT",
    "610": "INTOXICACION",
    "602": "CAIDA DE ALTURA",
    "918": "INTENTO SUICIDIO",
    "617": "SINTOMAS GASTROINTESTINALES",
    "SONTOMAS GASTROINTESTINALES": "SINTOMAS GASTROINTESTINALES",
    "607": "PATOLOGIA GINECOBSTETRICA",
    "906": "VIOLENCIA SEXUAL",
    "616": "SANGRADO VAGINAL",
    "605": "DOLOR TORAXICO",
    "611": "MALTRATO",
    "606": "ELECTROCUCION",
    "615": "QUEMADURAS",
    "715": "EVENTO NATURAL",
    "SIN_D": None,
}

# --- fixed values: priority codes -----------------------------------------
PRIORITIES = {"1": "CRITICA", "2": "ALTA", "3": "MEDIA", "4": "BAJA"}

# --- fixed values: locality names and their codes --------------------------
LOCALITY_CODES = {
    "USAQUEN": 1,
    "CHAPINERO": 2,
    "SANTA FE": 3,
    "SAN CRISTOBAL": 4,
    "USME": 5,
    "TUNJUELITO": 6,
    "BOSA": 7,
    "KENNEDY": 8,
    "FONTIBON": 9,
    "ENGATIVA": 10,
    "SUBA": 11,
    "BARRIOS UNIDOS": 12,
    "TEUSAQUILLO": 13,
    "LOS MARTIRES": 14,
    "ANTONIO NARINO": 15,
    "PUENTE ARANDA": 16,
    "CANDELARIA": 17,
    "RAFAEL URIBE URIBE": 18,
    "CIUDAD BOLIVAR": 19,
    "SUMAPAZ": 20,
}

# --- fixed values: misspelt locality names ---------------------------------
LOCALITY_CORRECTIONS = {
    "SAN CRISTNBAL": "SAN CRISTOBAL",
    "ENGATIVAX": "ENGATIVA",
    "FONTIBNN": "FONTIBON",
    "LOS MAXRTIRES": "LOS MARTIRES",
    "LA CANDELARIA": "CANDELARIA",
}

# --- fixed values: weekday labels, Monday first ----------------------------
WEEKDAYS_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
WEEKDAYS_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# --- fixed values: value of a filter that means "no filter" ----------------
ALL_VALUES = "TODAS"

# Texts that say "no value given", so that their absence is no parsing failure.
DECLARED_MISSING = ["NAN", "SIN_D", "SIN_DATO", "", "NULL"]
