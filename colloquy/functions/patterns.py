"""Regular-expression building blocks shared by the Spark functions and the
DuckDB oracle text.

Python's ``\\s`` and ``\\w`` are Unicode-aware; Java's and RE2's are ASCII. The
classes below spell out Python's sets so that Spark (Java regex) and DuckDB
(RE2) agree with the original behaviour, and every pattern avoids
look-around (RE2 has none).
"""

# The characters Python's str.isspace() accepts.
WS_CHARS = (r"\t\n\x0B\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = f"[{WS_CHARS}]"
NOT_WS = f"[^{WS_CHARS}]"
# The same set for Java regex: the Unicode White_Space property plus the four
# separator controls Python also counts (faster than the spelled-out class).
# The oracle SQL keeps the RE2 spelling above; both denote the same set.
WS_CHARS_J = r"\p{IsWhite_Space}\x{1C}-\x{1F}"
WS_J = f"[{WS_CHARS_J}]"
NOT_WS_J = f"[^{WS_CHARS_J}]"
# The same set as a plain string, for character-set trimming.
WS_STRING = ("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680"
             + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")

# Python \w on str: letters, numbers, underscore.
WORD_CHARS = r"\p{L}\p{N}_"
WORD = f"[{WORD_CHARS}]"
DIGIT = r"\p{Nd}"

# Emoji code-point ranges removed by the emoji stripper, in the
# order they are listed by the original cleaner.
EMOJI_RANGES = [
    ("1F1E0", "1F1FF"),  # flags
    ("1F300", "1F5FF"),  # symbols & pictographs
    ("1F600", "1F64F"),  # emoticons
    ("1F680", "1F6FF"),  # transport & map symbols
    ("1F700", "1F77F"),  # alchemical symbols
    ("1F780", "1F7FF"),  # geometric shapes extended
    ("1F800", "1F8FF"),  # supplemental arrows-C
    ("1F900", "1F9FF"),  # supplemental symbols and pictographs
    ("1FA00", "1FA6F"),  # chess symbols
    ("1FA70", "1FAFF"),  # symbols and pictographs extended-A
    ("2702", "27B0"),    # dingbats
]
EMOJI = "[" + "".join(f"\\x{{{a}}}-\\x{{{b}}}" for a, b in EMOJI_RANGES) + "]"
# The same for Java regex: one comparison leaves out what stands below them all,
# so that plain text costs no walk through the ranges.
EMOJI_J = r"(?=[^\x00-\x{2701}])" + EMOJI
ANIMATED_EMOTICON = f"<a:[^:]+:{DIGIT}+>"
EMOTICON = f":{WORD}+:"

# Wider emoji set of the summary cleaner, in the original order
# (the dingbats range is listed twice there; single characters as a..a).
WIDE_EMOJI_RANGES = [
    ("1F600", "1F64F"), ("1F300", "1F5FF"), ("1F680", "1F6FF"), ("1F1E0", "1F1FF"),
    ("2500", "2BEF"), ("2702", "27B0"), ("2702", "27B0"), ("24C2", "1F251"),
    ("1F926", "1F937"), ("10000", "10FFFF"), ("2640", "2642"), ("2600", "2B55"),
    ("200D", "200D"), ("23CF", "23CF"), ("23E9", "23E9"), ("231A", "231A"),
    ("FE0F", "FE0F"), ("3030", "3030"),
]
WIDE_EMOJI = "[" + "".join(f"\\x{{{a}}}-\\x{{{b}}}" for a, b in WIDE_EMOJI_RANGES) + "]+"

URL = f"(?:https?://|www\\.){NOT_WS}+"
URL_J = f"(?:https?://|www\\.){NOT_WS_J}+"
TOKEN = f"[{WORD_CHARS}-]*\\p{{L}}[{WORD_CHARS}-]*"
MENTION = r"<@(\d+)>"
LOG_TIME = r"\d{2}-\d{2}-\d{4}@\d{2}:\d{2}"
SENTENCE = r"[^.!?]+[.!?]*"
