"""Values fixed by the incident data set and its reporting rules."""

# --- fixed values: code dictionaries -----------------------------------------
WEATHER_LABELS = {
    "1": "Despejado",
    "2": "Lluvia débil",
    "3": "Lluvia fuerte",
    "4": "Granizo",
    "5": "Nevada",
    "6": "Niebla/Bruma",
    "7": "Viento fuerte",
    "8": "Otros",
    "9": "Desconocido",
}

LIGHT_LABELS = {
    "1": "Pleno día",
    "2": "Crepúsculo",
    "3": "Noche (Ilum. suficiente)",
    "4": "Noche (Ilum. insuficiente)",
    "5": "Noche (Sin iluminación)",
    "9": "Otros",
}

INCIDENT_TYPE_LABELS = {
    "13": "Obstáculo en calzada",
    "14": "Atropello",
    "0": "Otros",
}

MONTH_LABELS = {
    "1": "Enero",
    "2": "Febrero",
    "3": "Marzo",
    "4": "Abril",
    "5": "Mayo",
    "6": "Junio",
    "7": "Julio",
    "8": "Agosto",
    "9": "Septiembre",
    "10": "Octubre",
    "11": "Noviembre",
    "12": "Diciembre",
}

WEEKDAY_LABELS = {
    "1": "Lunes",
    "2": "Martes",
    "3": "Miércoles",
    "4": "Jueves",
    "5": "Viernes",
    "6": "Sábado",
    "7": "Domingo",
}

# --- fixed values: words and labels ------------------------------------------
DAY_KEYWORDS = ("día", "dia", "diurn", "plena luz", "luz diurna")
TRUE_WORDS = ("true", "1", "t", "yes", "y", "si", "sí")
UNKNOWN_LABEL = "Desconocido"
DAY_LABEL, NOT_DAY_LABEL = "Día", "No día"
SEGMENT_LABEL, NOT_SEGMENT_LABEL = "Estratégica", "NO estratégica"

# --- fixed values: segment, scenario and what-if parameters ------------------
SEGMENT_WEATHER = (6,)
SEGMENT_LIGHT = (4, 5)
SEGMENT_ZONE = ("1",)
SCENARIO_SEED = 20260114
SCENARIO_GROWTH = 0.01
GROWTH_LIMIT = 0.05
UPLIFT_SEGMENT_DAY = (0.035, 0.090)
UPLIFT_SEGMENT_OTHER = (0.015, 0.040)
UPLIFT_REST = (0.004, 0.010)
REDUCTION_FACTOR = 0.7
BASE_YEAR, SCENARIO_YEAR = 2024, 2026
TIME_ZONE = "Europe/Madrid"
