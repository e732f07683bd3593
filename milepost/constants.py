"""Fixed values of the fleet data model: word lists, patterns, labels, weights, messages.

Everything in this file has to be exactly as it is for results to be right;
nothing here is computed.
"""

# --- text cleaning -----------------------------------------------------------
NULL_TOKENS = ("null", "none", "nan", "n/a", "na", "-")
MISSING_TEXT = "sem dado"
UNNAMED_DRIVER = "(sem nome)"

ACCENTED = "ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑáàãâäéèêëíìîïóòôõöúùûüçñ"
UNACCENTED = "AAAAAEEEEIIIIOOOOOUUUUCNaaaaaeeeeiiiiooooouuuucn"

# --- dates in values and in file names ---------------------------------------
EVENT_TIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
)
TRIP_TIME_FORMATS = ("dd/MM/yyyy HH:mm:ss",)

# style -> (pattern of the date inside a file name, format once "-" became "_")
FILE_DATE_STYLES = {
    "padded": (r"(\d{4}_\d{2}_\d{2})", "yyyy_MM_dd"),
    "loose": (r"(\d{4}_\d{1,2}_\d{1,2})", "yyyy_M_d"),
    "any_sep": (r"(\d{4}[_-]\d{1,2}[_-]\d{1,2})", "yyyy_M_d"),
}

# --- feeds --------------------------------------------------------------------
# silver table -> name of its landing folder after the export prefix
LANDING_FOLDERS = {
    "drivers": "drivers",
    "events": "events",
    "groups": "group",
    "schemes": "schemes",
    "trips": "trips",
    "vehicles": "vehicles",
}
BRONZE_PREFIX = "bronze/"
REQUIRED_SILVER = ("drivers", "groups", "schemes", "vehicles", "trips", "events")

# longest text kept by the scheme dimension
SCHEME_TEXT_LENGTHS = {
    "scheme_description": 600,
    "description": 600,
    "parent_scheme": 300,
    "scheme_type": 200,
}

# --- trip counters --------------------------------------------------------------
SAFETY_COUNTERS = (
    "turn1", "turn2", "turn3",
    "break1", "break2", "break3",
    "acceleration1", "acceleration2", "acceleration3",
    "speed_road1", "speed_road2", "speed_road3",
)

# --- classifiers: first matching fragment wins ---------------------------------
DRIVING_ERRORS = (
    (("aceleracao",), "Aceleração Brusca"),
    (("curva",), "Curva Brusca"),
    (("fread",), "Freada Brusca"),
    (("poschave",), "Dirigir com pós-chave desligado"),
    (("fadiga",), "Fadiga"),
    (("overspeed", "speeding"), "Excesso de velocidade em pista seca"),
    (("banguela",), "Dirigir na banguela"),
    (("pedaldefreio",), "Excesso de uso do pedal de freio >30 km/h"),
    (("abs",), "ABS acionado"),
    (("freiodemao",), "Estacionar sem freio de mão"),
)

PEDAL_WORD = "pedal"
PEDAL_ISSUES = (
    (("embreagem",), "Falha na embreagem"),
    (("accelerator", "acelerador"), "Uso excessivo de potência"),
    (("brake", "freio"), "Falha no freio/ABS"),
)
PEDAL_OTHER = "Outros"

COMPONENTS = (
    (("engine",), "engine"),
    (("brak", "abs"), "braking"),
    (("gear", "transmission"), "gearbox"),
    (("clutch",), "clutch"),
    (("electric",), "electrical"),
    (("suspension",), "suspension"),
)
COMPONENT_OTHER = "other"
HEALTH_WEIGHTS = {"engine": 5, "braking": 4, "gearbox": 4, "clutch": 3}
HEALTH_LEVELS = ((300, "Crítico"), (1000, "Atenção"))
HEALTH_GOOD = "OK"

ENERGY_TYPES = (
    (("diesel", "gasoline", "etanol", "flex"), "Combustão"),
    (("electric", "ev", "elétrico", "eletrico"), "Elétrico"),
    (("cng", "gnv", "lng", "gas"), "Gás"),
)
ENERGY_UNKNOWN = "Desconhecido"
ELECTRIC_ENGINE = "Elétrico"

# --- driver score: 100 minus a weight per event of the type ---------------------
SCORE_START = "100"
SCORE_SAFETY = ("Safety", "1.0")
SCORE_ECONOMY = ("Economy", "0.5")
SCORE_OTHER = "0.1"

# --- economy offenders: trip counter, label, advice -----------------------------
ECONOMY_OFFENDERS = (
    ("engine", "Uso excessivo de potência",
     "Troque as marchas dentro da faixa verde e evite aceleração prolongada no pedal máximo."),
    ("speed_road3", "Excesso de velocidade tracionando",
     "Reduza a velocidade antes das curvas e mantenha tração dentro dos limites definidos."),
    ("acceleration3", "Aceleração brusca",
     "Acelere progressivamente e mantenha condução suave para reduzir consumo."),
    ("idle_duration", "Ociosidade",
     "Desligue o motor em paradas prolongadas para evitar consumo desnecessário."),
    ("gearbox", "Uso excessivo de transmissão",
     "Evite trocar marchas fora da rotação ideal e mantenha operação suave."),
)

# --- texts shown to users ----------------------------------------------------------
TREND = {"none": "sem histórico", "better": "melhorou", "worse": "piorou", "same": "igual"}

CONTRIBUTION = {
    "positive": "Contribuiu positivamente para a economia da frota.",
    "negative": "Contribuiu negativamente para a economia da frota.",
    "neutral": "Contribuição neutra.",
}

NO_HISTORY = "Sem histórico anterior para comparação."
VS_LAST_MONTH = "% em relação ao mês anterior."

ECONOMY_MESSAGE = {
    "none": NO_HISTORY,
    "better": ("Seu percentual de economia melhorou ", VS_LAST_MONTH),
    "worse": ("Seu percentual de economia piorou ", VS_LAST_MONTH),
    "same": "Seu percentual de economia permaneceu estável em relação ao mês anterior.",
}
FLEET_SAFETY_MESSAGE = {
    "none": NO_HISTORY,
    "better": ("A segurança da frota melhorou ", VS_LAST_MONTH),
    "worse": ("A segurança da frota piorou ", VS_LAST_MONTH),
    "same": "A segurança da frota permaneceu estável em relação ao mês anterior.",
}
DRIVER_SAFETY_MESSAGE = {
    "none": "Motorista sem histórico suficiente para comparação.",
    "better": ("O motorista melhorou ", VS_LAST_MONTH),
    "worse": ("O motorista piorou ", VS_LAST_MONTH),
    "same": "O motorista manteve o mesmo nível de segurança em relação ao mês anterior.",
}
REFERENCE_DRIVER = " Motorista de referência: "
GROUP_ECONOMY_MESSAGE = ("Sua média de economia para a frota ", " é de ", " km/l.")
