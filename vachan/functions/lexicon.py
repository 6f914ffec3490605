"""Lexicons used by the text operators.

Every word list below is data, not logic: the operators take a lexicon
argument and these are only the defaults.  They are kept here together, in
their natural order, because results must equal the published behaviour
word for word.  All strings are brought to Unicode NFC at import time (the
nukta letters U+0958..U+095F are composition exclusions, so NFC keeps them as
letter + U+093C).
"""

from __future__ import annotations

import unicodedata

# ───────────────────────────── FIXED VALUES ─────────────────────────────────
# Number words (kind "unit": 0-19, kind "ten": 20-99, kind "multiplier").
UNIT_WORDS = [
    ("शून्य", 0), ("एक", 1), ("दो", 2), ("तीन", 3), ("चार", 4),
    ("पाँच", 5), ("पांच", 5), ("छह", 6), ("छः", 6), ("सात", 7),
    ("आठ", 8), ("नौ", 9), ("दस", 10), ("ग्यारह", 11), ("बारह", 12),
    ("तेरह", 13), ("चौदह", 14), ("पंद्रह", 15), ("सोलह", 16), ("सत्रह", 17),
    ("अठारह", 18), ("उन्नीस", 19),
]
TEN_WORDS = [
    ("बीस", 20), ("इक्कीस", 21), ("बाईस", 22), ("तेईस", 23), ("चौबीस", 24),
    ("पच्चीस", 25), ("छब्बीस", 26), ("सत्ताईस", 27), ("अट्ठाईस", 28), ("उनतीस", 29),
    ("तीस", 30), ("इकतीस", 31), ("बत्तीस", 32), ("तैंतीस", 33), ("चौंतीस", 34),
    ("पैंतीस", 35), ("छत्तीस", 36), ("सैंतीस", 37), ("अड़तीस", 38), ("उनतालीस", 39),
    ("चालीस", 40), ("इकतालीस", 41), ("बयालीस", 42), ("तैंतालीस", 43), ("चवालीस", 44),
    ("पैंतालीस", 45), ("छियालीस", 46), ("सैंतालीस", 47), ("अड़तालीस", 48), ("उनचास", 49),
    ("पचास", 50), ("इक्यावन", 51), ("बावन", 52), ("तिरपन", 53), ("चौवन", 54),
    ("पचपन", 55), ("छप्पन", 56), ("सत्तावन", 57), ("अट्ठावन", 58), ("उनसठ", 59),
    ("साठ", 60), ("इकसठ", 61), ("बासठ", 62), ("तिरसठ", 63), ("चौंसठ", 64),
    ("पैंसठ", 65), ("छियासठ", 66), ("सड़सठ", 67), ("अड़सठ", 68), ("उनहत्तर", 69),
    ("सत्तर", 70), ("इकहत्तर", 71), ("बहत्तर", 72), ("तिहत्तर", 73), ("चौहत्तर", 74),
    ("पचहत्तर", 75), ("छिहत्तर", 76), ("सतहत्तर", 77), ("अठहत्तर", 78), ("उन्यासी", 79),
    ("अस्सी", 80), ("इक्यासी", 81), ("बयासी", 82), ("तिरासी", 83), ("चौरासी", 84),
    ("पचासी", 85), ("छियासी", 86), ("सतासी", 87), ("अट्ठासी", 88), ("नवासी", 89),
    ("नब्बे", 90), ("इक्यानबे", 91), ("बानवे", 92), ("तिरानवे", 93), ("चौरानवे", 94),
    ("पचानवे", 95), ("छियानवे", 96), ("सत्तानवे", 97), ("अट्ठानवे", 98), ("निन्यानवे", 99),
]
MULTIPLIER_WORDS = [
    ("सौ", 100), ("हज़ार", 1000), ("हजार", 1000),
    ("लाख", 100_000), ("करोड़", 10_000_000),
]

# Frozen phrases whose number words are never converted.
IDIOM_PHRASES = [
    "दो-चार", "दो चार", "चार-छह", "सात-आठ", "पाँच-सात", "पांच-सात",
    "दो-तीन", "दो तीन", "तीन-चार", "तीन चार", "चार-पाँच", "चार पांच",
    "एक-दो", "एक दो", "दस-बीस", "बीस-पच्चीस", "सौ-दो सौ", "हज़ार-दो हज़ार",
    "सात आठ", "पाँच छह", "छह सात", "नौ दस",
]

# English loanwords (Devanagari, then Roman script).
LOANWORDS = [
    "इंटरव्यू", "इंटरव्यूअर", "जॉब", "ऑफिस", "मैनेजर", "टीम", "प्रोजेक्ट",
    "मीटिंग", "प्रेजेंटेशन", "फीडबैक", "टारगेट", "सेल्स", "मार्केट",
    "कंपनी", "बिज़नेस", "सैलरी", "बोनस", "प्रमोशन", "ट्रेनिंग", "इंटर्नशिप",
    "रिज्यूमे", "प्रोफाइल", "लिंक्डइन", "ईमेल", "लैपटॉप", "कंप्यूटर",
    "सॉफ्टवेयर", "ऐप", "वेबसाइट", "ऑनलाइन", "ऑफलाइन", "डिजिटल",
    "इंटरनेट", "वाई-फाई", "फोन", "स्मार्टफोन", "चार्जर",
    "लोन", "ईएमआई", "क्रेडिट", "डेबिट", "बैंक", "अकाउंट", "ट्रांसफर",
    "पेमेंट", "कैश", "चेक", "इनवॉइस", "रिसीट",
    "कोर्स", "क्लास", "टेस्ट", "एग्जाम", "रिजल्ट", "मार्क्स", "ग्रेड",
    "सर्टिफिकेट", "डिग्री", "कॉलेज", "यूनिवर्सिटी", "स्कूल", "टीचर",
    "टाइम", "डेट", "प्लान", "स्टेशन", "बस", "ट्रेन", "फ्लाइट",
    "होटल", "रूम", "टिकट", "बुकिंग", "चेक-इन", "चेक-आउट",
    "स्किल", "एक्सपीरियंस", "पोटेंशियल", "परफॉर्मेंस", "रिव्यू",
    "प्रॉब्लम", "सॉल्यूशन", "चैलेंज", "गोल", "टास्क", "रिस्पॉन्सिबिलिटी",
    "कूल", "फाइन", "ओके", "सॉरी", "थैंक्यू", "प्लीज़", "हेलो",
    "हाय", "बाय", "गुड", "बेस्ट", "ग्रेट", "नाइस", "परफेक्ट",
    "interview", "job", "office", "manager", "team", "project",
    "meeting", "salary", "company", "email", "laptop", "computer",
    "software", "app", "website", "online", "phone", "bank",
    "account", "payment", "course", "class", "test", "exam",
    "result", "marks", "degree", "college", "university", "skill",
    "experience", "problem", "solution", "goal", "task", "ok", "okay",
    "sorry", "thanks", "please", "hello", "hi", "bye", "good", "best",
    "great", "nice", "perfect", "cool", "fine",
]

# Canonicalisation rewrites, applied in this order (variant, canonical).
ORDINAL_REWRITES = [
    ("1st", "पहली"), ("1ला", "पहला"), ("1ली", "पहली"),
    ("2nd", "दूसरी"), ("2रा", "दूसरा"), ("2री", "दूसरी"),
    ("3rd", "तीसरी"), ("3रा", "तीसरा"),
    ("4th", "चौथी"), ("4था", "चौथा"),
    ("5th", "पाँचवीं"), ("5वाँ", "पाँचवाँ"), ("5वीं", "पाँचवीं"),
    ("6th", "छठी"), ("7th", "सातवीं"), ("8th", "आठवीं"), ("9th", "नौवीं"),
    ("10th", "दसवीं"),
]
NUMBER_WORD_REWRITES = [
    ("एक", "1"), ("दो", "2"), ("तीन", "3"), ("चार", "4"), ("पाँच", "5"),
    ("छह", "6"), ("सात", "7"), ("आठ", "8"), ("नौ", "9"), ("दस", "10"),
    ("ग्यारह", "11"), ("बारह", "12"), ("तेरह", "13"), ("चौदह", "14"),
    ("पंद्रह", "15"), ("सोलह", "16"), ("सत्रह", "17"), ("अठारह", "18"),
    ("उन्नीस", "19"), ("बीस", "20"), ("तीस", "30"), ("चालीस", "40"),
    ("पचास", "50"), ("साठ", "60"), ("सत्तर", "70"), ("अस्सी", "80"),
    ("नब्बे", "90"), ("सौ", "100"), ("हज़ार", "1000"),
]
SCHWA_REWRITES = [
    ("करन", "करना"), ("बोलन", "बोलना"), ("देखन", "देखना"),
    ("समझन", "समझना"), ("पढ़न", "पढ़ना"), ("लिखन", "लिखना"),
    ("सुनन", "सुनना"), ("जान", "जाना"), ("आन", "आना"),
    ("खान", "खाना"), ("पीन", "पीना"), ("सोन", "सोना"),
    ("उठन", "उठना"), ("बैठन", "बैठना"), ("चलन", "चलना"),
    ("दौड़न", "दौड़ना"), ("सीखन", "सीखना"), ("सिखान", "सिखाना"),
    ("बतान", "बताना"), ("दिखान", "दिखाना"), ("मिलन", "मिलना"),
    ("भेजन", "भेजना"), ("लेन", "लेना"), ("देन", "देना"),
    ("पान", "पाना"), ("रखन", "रखना"), ("छोड़न", "छोड़ना"),
    ("मारन", "मारना"), ("बचान", "बचाना"), ("बनान", "बनाना"),
    ("जीतन", "जीतना"), ("हारन", "हारना"), ("कहन", "कहना"),
    ("सोचन", "सोचना"), ("समझान", "समझाना"), ("पहुँचन", "पहुँचना"),
    ("रुकन", "रुकना"), ("शुरू करन", "शुरू करना"),
    ("होन", "होना"), ("रहन", "रहना"), ("जीन", "जीना"),
]

# Devanagari digits zero..nine and their ASCII counterparts.
DEVANAGARI_DIGITS = "०१२३४५६७८९"
ASCII_DIGITS = "0123456789"

# Token marks removed before scoring (each becomes a space).
SCORING_PUNCTUATION = "।?!,.-—'\"()[]{}:;~@#^*+=<>/\\|`_"

# Systems of the multi-system evaluation sheet, in sheet order.
SYSTEMS = ["Model H", "Model i", "Model k", "Model l", "Model m", "Model n"]
# ─────────────────────────── END FIXED VALUES ───────────────────────────────


def _nfc(s: str) -> str:
    return unicodedata.normalize("NFC", s)


UNIT_WORDS = [(_nfc(w), v) for w, v in UNIT_WORDS]
TEN_WORDS = [(_nfc(w), v) for w, v in TEN_WORDS]
MULTIPLIER_WORDS = [(_nfc(w), v) for w, v in MULTIPLIER_WORDS]
IDIOM_PHRASES = [_nfc(p) for p in IDIOM_PHRASES]
LOANWORDS = list(dict.fromkeys(_nfc(w) for w in LOANWORDS))
ORDINAL_REWRITES = [(_nfc(a), _nfc(b)) for a, b in ORDINAL_REWRITES]
NUMBER_WORD_REWRITES = [(_nfc(a), _nfc(b)) for a, b in NUMBER_WORD_REWRITES]
SCHWA_REWRITES = [(_nfc(a), _nfc(b)) for a, b in SCHWA_REWRITES]

# Additive words (units and tens) and multipliers as lookup dictionaries;
# the keys of the three lists are disjoint, so the merge order is moot.
ADDITIVE_VALUES = dict(UNIT_WORDS + TEN_WORDS)
MULTIPLIER_VALUES = dict(MULTIPLIER_WORDS)
NUMBER_WORDS = {**ADDITIVE_VALUES, **MULTIPLIER_VALUES}
