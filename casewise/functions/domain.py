"""Fixed values of the public-health and complaint domains.

All of them are defaults of operator parameters; none is read inside an operator.
"""

# Category of each notifiable event code.
EVENT_CATEGORIES = {
    205: "VECTORIAL",
    210: "VECTORIAL",
    217: "VECTORIAL",
    220: "VECTORIAL",
    420: "VECTORIAL",
    430: "VECTORIAL",
    440: "VECTORIAL",
    460: "VECTORIAL",
    470: "VECTORIAL",
    490: "VECTORIAL",
    495: "VECTORIAL",
    540: "VECTORIAL",
    580: "VECTORIAL",
    895: "VECTORIAL",
    230: "INMUNOPREVENIBLE",
    320: "INMUNOPREVENIBLE",
    330: "INMUNOPREVENIBLE",
    340: "INMUNOPREVENIBLE",
    341: "INMUNOPREVENIBLE",
    345: "INMUNOPREVENIBLE",
    348: "INMUNOPREVENIBLE",
    500: "INMUNOPREVENIBLE",
    510: "INMUNOPREVENIBLE",
    520: "INMUNOPREVENIBLE",
    530: "INMUNOPREVENIBLE",
    620: "INMUNOPREVENIBLE",
    730: "INMUNOPREVENIBLE",
    760: "INMUNOPREVENIBLE",
    770: "INMUNOPREVENIBLE",
    800: "INMUNOPREVENIBLE",
    810: "INMUNOPREVENIBLE",
    820: "INMUNOPREVENIBLE",
    825: "INMUNOPREVENIBLE",
    831: "INMUNOPREVENIBLE",
    110: "MATERNO_INFANTIL",
    112: "MATERNO_INFANTIL",
    113: "MATERNO_INFANTIL",
    298: "MATERNO_INFANTIL",
    343: "MATERNO_INFANTIL",
    549: "MATERNO_INFANTIL",
    550: "MATERNO_INFANTIL",
    560: "MATERNO_INFANTIL",
    590: "MATERNO_INFANTIL",
    600: "MATERNO_INFANTIL",
    735: "MATERNO_INFANTIL",
    740: "MATERNO_INFANTIL",
    750: "MATERNO_INFANTIL",
    100: "ZOONOTICO",
    300: "ZOONOTICO",
    450: "ZOONOTICO",
    455: "ZOONOTICO",
    228: "INTOX_VIOLENCIA",
    356: "INTOX_VIOLENCIA",
    360: "INTOX_VIOLENCIA",
    370: "INTOX_VIOLENCIA",
    380: "INTOX_VIOLENCIA",
    390: "INTOX_VIOLENCIA",
    400: "INTOX_VIOLENCIA",
    410: "INTOX_VIOLENCIA",
    412: "INTOX_VIOLENCIA",
    414: "INTOX_VIOLENCIA",
    452: "INTOX_VIOLENCIA",
    875: "INTOX_VIOLENCIA",
    155: "CRONICO",
    456: "CRONICO",
    457: "CRONICO",
    459: "CRONICO",
    850: "CRONICO",
    305: "OTROS",
}

# Numeric label of each category.
CATEGORY_LABELS = {
    "VECTORIAL": 0,
    "INMUNOPREVENIBLE": 1,
    "MATERNO_INFANTIL": 2,
    "ZOONOTICO": 3,
    "INTOX_VIOLENCIA": 4,
    "CRONICO": 5,
    "OTROS": 6,
}

DEFAULT_CATEGORY = "OTROS"
UNKNOWN_TOWN = "MUNICIPIO DESCONOCIDO"

# Spanish stop words.
STOP_WORDS_ES = [
    "de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una",
    "su", "al", "es", "lo", "como", "mas", "pero", "sus", "le", "ya", "o", "fue", "este", "ha", "entre", "cuando",
    "todo", "esta", "ser", "son", "tambien", "era", "muy", "anos", "desde", "hasta", "donde", "solo", "durante",
    "cada", "e", "i", "u", "sobre", "sin", "tiene", "han", "otros", "porque", "todos", "cual", "vez", "otro",
    "tanto", "despues", "antes", "si", "puede", "parte", "hace", "dia", "forma", "tipo", "tener", "bien", "mayor",
    "alguna", "asi", "luego", "dentro", "aunque", "hecho", "sido", "tres", "hacer", "mismo", "debido", "cuenta",
    "estos", "pueden", "ellas", "general", "menos", "diferentes", "mejor", "ademas", "casi", "veces", "nuestro",
    "tan", "tras", "toda", "siendo", "dos", "misma", "ningun", "dicho", "fuera", "siempre", "largo", "mucho",
    "poco", "medio", "nueva", "buen", "ninguna", "da", "va", "dice", "hacia",
]

# Words that mark a severe or an improving report.
SEVERITY_WORDS = [
    "alto", "elevado", "grave", "severo", "critico", "epidemia", "brote", "alerta", "emergencia", "complejo",
]
RELIEF_WORDS = [
    "bajo", "leve", "control", "descenso", "mejora", "disminucion", "estable", "controlado", "positivo",
]

# Numeric code of each sentiment; anything else counts as neutral.
SENTIMENT_CODES = {"POS": 0, "NEU": 1, "NEG": 2}
NEUTRAL_CODE = 1


def event_category_rows() -> list[tuple[int, str, int]]:
    """(code, category, label) for every known event code."""
    return [(code, category, CATEGORY_LABELS[category]) for code, category in EVENT_CATEGORIES.items()]
