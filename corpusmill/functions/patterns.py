"""Fixed values that define the semantics: character classes, word lists and limits.

Patterns use ``\\x{....}`` escapes, which Java's and DuckDB's engines both read. The diacritic classes differ on purpose.
"""

# Classes of characters.
WHITE_SPACE = r"[\x{0009}-\x{000d}\x{001c}-\x{0020}\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DIRTY = r"[\x{0640}\x{064b}-\x{065f}\x{0670}\x{0671}\x{06d6}-\x{06ed}\x{060c}\x{061b}\x{061f}\x{0660}-\x{0669}\x{066a}-\x{066d}]"
NORMAL_MARKS = r"[\x{0640}\x{064b}-\x{065f}\x{0670}\x{0671}\x{06d6}-\x{06dc}\x{06df}-\x{06e4}\x{06e7}-\x{06e8}\x{06ea}-\x{06ed}]"
CONTROLS = r"[\x{0000}-\x{0008}\x{000b}\x{000c}\x{000e}-\x{001f}\x{007f}-\x{009f}\x{200b}-\x{200f}\x{2060}-\x{206f}]"
DEDUP_MARKS = r"[\x{0640}\x{064b}-\x{065f}\x{0670}\x{0671}\x{06d6}-\x{06ed}]"
LEXICON_SIGNS = r"[\x{0640}\x{064b}-\x{065f}\x{0670}\x{0671}\x{06d6}-\x{06ed}\x{060c}\x{061b}\x{061f}.,!?:\x{2026}\x{0022}'()\[\]{}]"
ASCII_BLANKS = r"[ \x{0009}\x{000d}\x{000a}\x{000c}\x{000b}]+"

# Letters that are unified, and what they become.
LETTERS_FROM, LETTERS_TO = "أإآؤئة", "اااويه"
CLITICS = "وفبلكسحع"
SPELLINGS, SPELLING = ("كدا", "كده"), "كذا"

# Metadata.
MULTI_SPEAKER = "More than 1 speaker اكثر من متحدث"
DIALECTS = ("najdi", "hijazi")
METADATA_COLUMNS = ("audio", "text", "cleaned_text", "speaker_age", "speaker_gender", "speaker_dialect")
DEMOGRAPHICS = ("speaker_age", "speaker_gender", "speaker_dialect")

# Words of other dialects. Those with a doubled letter's mark never match text without marks; kept as given.
EGYPTIAN = ("عايز", "عاوز", "إزاي", "ازاي", "بص", "بصّ", "كويس خالص", "أوي", "اوي", "دلوقتي")
LEVANTINE = ("بدّي", "بدي", "شو", "هلّق", "هلق", "هيك", "شو بدك", "مشان هيك", "شلونك خاي")
DRIFT = rf"(^|{WHITE_SPACE})({'|'.join(EGYPTIAN + LEVANTINE)})({WHITE_SPACE}|[.,\x{{060c}}!\x{{061f}}]|$)"

# Thresholds.
JACCARD, NGRAM, FEWEST_WORDS, LSH_ROWS = 0.75, 5, 6, 16
VOCABULARY, HOLDOUT, HOLDOUT_SEED, LEAST_PAIR = 16_000, 0.02, 42, 2
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>", "<pad>", "<mask>")
RARE_BELOW, LEAST_SPEAKERS = 50, 5
MAX_FERTILITY, MAX_SINGLE_RATE, MAX_DEAD_PCT, MEAN_LENGTH = 1.8, 5.0, 3.0, (3.5, 4.8)
UINT16_MAX, UNK_ID = 65_535, 0
KIND_RAW, KIND_SYNTHETIC = 0, 1
