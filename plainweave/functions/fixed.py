"""Values that have to be exactly these for results to agree."""

import math

# --- fixed values: instruction texts -------------------------------------
# The trailing space of the default is part of it: joined to the text by one
# more space it gives two.
DEFAULT_INSTRUCTION = "Vereenvoudig: "

INSTRUCTIONS = [
    "Vereenvoudig deze tekst:",
    "Kun je deze tekst makkelijker maken?",
    "Herschrijf dit in eenvoudigere taal:",
    "Maak deze tekst begrijpelijker:",
    "Schrijf dit in simpelere woorden:",
    "Vertaal dit naar makkelijkere taal:",
    "Maak dit leesbaar voor een breder publiek:",
    "Herschrijf dit zodat iedereen het kan begrijpen:",
    "Maak deze tekst toegankelijker:",
    "Schrijf dit in klare taal:",
    "Vereenvoudig dit stuk tekst:",
    "Kun je dit makkelijker uitleggen?",
    "Maak dit stuk tekst eenvoudiger:",
    "Herschrijf dit in begrijpelijke taal:",
    "Zet dit om naar eenvoudige taal:",
    "Maak dit makkelijker te lezen:",
    "Schrijf dit in simpele taal:",
    "Vertaal dit naar begrijpelijke woorden:",
    "Maak dit tekststuk eenvoudiger:",
    "Herschrijf dit in alledaagse taal:",
]

DEFAULT_SHARE = 0.2  # share of rows that get the default instruction anyway
SHORT_PROMPT = 100  # prompts shorter than this always get it

# --- fixed values: prompts -----------------------------------------------
SYSTEM_PROMPT = (
    "Je bent een AI-assistent die Nederlandse teksten vereenvoudigt naar een helder, "
    "toegankelijk niveau voor iedereen, vergelijkbaar met de heldere taal die het "
    "Jeugdjournaal gebruikt. Behoud de betekenis en belangrijke informatie, maar gebruik "
    "eenvoudigere woorden en kortere zinnen. Schrijf niet kinderlijk, maar wel toegankelijk."
)

TASK_PREFIX = "Vereenvoudig: "

BASELINE_PROMPT = (
    "Vereenvoudig een Nederlandse alinea tot één duidelijke en aantrekkelijke tekst geschikt "
    "voor volwassenen die Nederlands als tweede taal spreken. Gebruik woorden uit de "
    "basiswoordenlijst Amsterdamse kleuters. Behoud directe citaten en leg culturele "
    "verwijzingen, uitdrukkingen en technische termen natuurlijk uit in de tekst. Pas de "
    "volgorde van informatie aan voor eenvoud en leesbaarheid."
)

BASELINE_MARKER = "De alinea:"

# --- fixed values: chat layouts ------------------------------------------
# before role, between role and content, after content, between turns, and
# the text put once before the first turn.
TEMPLATES = {
    "role_tags": {
        "open": "<|start_of_role|>",
        "mid": "<|end_of_role|>",
        "close": "<|end_of_text|>",
        "between": "\n",
        "begin": "",
    },
    "header_ids": {
        "open": "<|start_header_id|>",
        "mid": "<|end_header_id|>\n\n",
        "close": "<|eot_id|>",
        "between": "",
        "begin": "<|begin_of_text|>",
    },
    "chatml": {
        "open": "<|im_start|>",
        "mid": "\n",
        "close": "<|im_end|>",
        "between": "\n",
        "begin": "",
    },
}

# --- fixed values: statistics --------------------------------------------
# Two-sided 95% Student t quantiles for 1..30 degrees of freedom.
T_CRITICAL_95 = [
    12.706204736432095, 4.302652729749464, 3.182446305284263, 2.7764451051977987,
    2.5705818366147395, 2.4469118487916806, 2.3646242510102993, 2.3060041350333704,
    2.2621571627409915, 2.2281388519649385, 2.200985160082949, 2.1788128296634177,
    2.1603686564610127, 2.1447866879169273, 2.131449545559323, 2.1199052992210112,
    2.1098155778331806, 2.10092204024096, 2.093024054408263, 2.0859634472658364,
    2.079613844727662, 2.0738730679040147, 2.0686576104190406, 2.0638985616280205,
    2.059538552753294, 2.055529438642871, 2.0518305164802833, 2.048407141795244,
    2.045229642132703, 2.0422724563012373,
]
NORMAL_95 = 1.96  # the verdict threshold
NORMAL_975 = 1.959963984540054  # the quantile that Student t tends to

# Lower bound (inclusive) of each quality band.
QUALITY_BANDS = [
    (0, "poor"),
    (30, "below average"),
    (50, "average"),
    (70, "good"),
    (85, "excellent"),
]

# Chances that a Poisson number of mean 1 is at most 0, 1, ... 9, from their rule.
POISSON_LIMITS = [round(sum(math.exp(-1.0) / math.factorial(j) for j in range(k + 1)), 12) for k in range(10)]
