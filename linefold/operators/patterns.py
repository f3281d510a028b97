"""Fixed values of the extractor: texts and types that its results depend on, stated plainly.

All patterns are Java regular expressions with Unicode classes.
"""

# Fixed values: (name, pattern with the number as its group, kind), in order of precedence.
START_PATTERNS = [
    ("문제", r"(?U)^\s*문제\s*(\d{1,4})", "문제"),
    ("문제", r"(?U)^\s*(?:탐구|확인|심화)\s*문제\s*(\d{1,4})", "문제"),
    ("예제", r"(?U)^\s*(?:필수\s*)?예제\s*(\d{1,4})", "예제"),
    ("유제", r"(?U)^\s*유제\s*(\d{1,4})", "유제"),
    ("탐구", r"(?U)^\s*(?:탐구|밤구)\s*(\d{1,3})", "탐구"),
    ("유형", r"(?U)^\s*유형\s*(\d{1,3})", "유형"),
    ("확인", r"(?U)^\s*확인\s*문제\s*(\d{1,3})", "문제"),
    ("서술형", r"(?U)^\s*서술형\s*(\d{1,3})", "문제"),
    ("추론", r"(?U)^\s*추[론롤]\s*(\d{1,3})", "문제"),
    ("문제해결", r"(?U)^\s*문제\s*해결\s*(\d{1,3})", "문제"),
    ("의사소통", r"(?U)^\s*의사[소솔]\s*[통동]\s*(\d{1,3})", "문제"),
    ("문제물음", r"(?U)^\s*문제\s*\\\((\s*\?\s*)\\\)", "문제"),
    ("두자리", r"(?U)^\s*(0\d)(?!\d)", "번호"),
    ("번호점", r"(?U)^\s*(\d{1,2})\s*[.．]\s*(?!\d)", "번호"),
    ("번호", r"(?U)^\s*(\d{1,2})(?=\s+(?:[가-힣(]|[A-Za-z]{2}|[A-Z]\s|\d\s*,\s*\d|\d{1,3}\s*[이가]\s*적힌))", "번호"),
    ("번호", r"(?U)^\s*(\d{1,2})(?=\s+\d{1,3}\s*(?:명|개|장|가지|마리|팀|자루|켤레|봉지|상자)[가-힣])", "번호"),
]
WEAK_START = ["번호점", "번호"]
# Names as shown.
DISPLAY_NAME = {
    "두자리": "문제",
    "번호": "문제",
    "번호점": "문제",
    "확인": "문제",
    "지문": "문제",
    "문제물음": "문제",
    "문제해결": "문제",
    "추론": "문제",
    "의사소통": "문제",
    "서술형": "서술형",
    "활동의심": "문제",
}
# A number inside a formula frame, and how to read it.
DELATEX = [
    (r"(?U)^(\s*[가-힣]{0,4}\s*)\\\(\s*(\d{1,2})\s*\\quad\s*", "$1$2 "),
    (r"(?U)^\s*\\\((\d)(?=\d\s*,\s*\d)", "$1 "),
    (r"(?U)^(\s*[가-힣]{1,4}\s*)\\\(\s*(\d{1,2})\s+(?![.\d])", r"$1$2 \\\\("),
]
# How a task ends, and other guards.
ORDER_END = r"(?U)(?:시오|하라|보자|구해라|말해라)\s*[.．,，]?\s*(?:[(（][^)）]{0,60}[)）])?\s*[.．]?\s*$"
ORDER_END_ANY = r"(?U)(?:시오|하라|보자|구해라|말해라)\s*[.．,，)）]"
STRONG_END = r"[?？]|[여아으]라[.．]?|하라|시오|구해라|말해라"
CONCEPT_HEAD = r"(?U)^\s*\d{1,2}\s+.{0,24}(일까|할까)"
FALSE_FOLLOW = (
    r"(?U)^\s*\d{1,2}\s*[.．]?\s*(이상|이하|초과|미만|부터|까지|개|명|번|회|장|쪽|권|팀|조|마리|자루|켤레|봉지|상자"
    r"|원|년|월|일|시간|시|분|초|살|점|배|가지|자리|칸|줄|행|열|이다|이며|이고|의|는|은|을|를|이(?![가-힣])|가|와|과|로|에)"
)
FALSE_FOLLOW_KEEP = r"(?U)^\s*\d[1-9]\s*(?:명|개|장|가지|마리|팀|자루|켤레|봉지|상자)[가-힣]"
SOLUTION_BIT = r"(?U)^\s*\d{1,2}\s*[.．)]?\s*(풀이|답|증명)\b|^\s*풀이\s*[(（]"
ACTIVITY_INTRO = r"(?U)(알아|살펴|생각해|확인해|정리해)\s*보자\s*[.．]?\s*$"
REVIEW_CORNER = r"(?U)스스로\s*준\W{0,2}비|준\W{0,2}비\W{0,2}학\W{0,2}습|창\W{0,2}의\W{0,2}융\W{0,2}합"
PREP_HEAD = r"(?U)준[^가-힣]{0,2}비[^가-힣]{0,2}학[^가-힣]{0,2}습|준\s*비\s*하\s*기"
INTRO_CORNER = r"(?U)^\s*(준\s*비\s*하\s*기|다\s*가\s*서\s*기)\s*$"
SUB_ITEM = r"(?U)^\s*[(（\[]\s*\d{1,2}\s*[)）\]]|^\s*[①-⑳]|^\s*[⑴-⒇]"
CHOICE_HEAD = r"(?U)^[\[|]?\s*보\s?기\s*[\]|]?$"
CHOICE_ITEM = r"(?U)^\s*[ㄱ-ㅎᄀ-ᄒ]\s*[.．)]"
PROVISO = r"(?U)^\s*[(（]?\s*(단|주의|참고로)\s*[,，]"
SOLUTION = r"(?U)^\s*(풀이|풀OI|답|정답|증명|정명|증멍|해설|해답|참고)"
FIGURE_REF = r"(?U)(오른쪽|아래|위의|다음)\s*(그림|표|도형)|그림과\s*같이|그림에서|그림은|정팔면체|정사면체|직육면체|정육면체"
# Line types.
BODY_TYPES = [
    "text",
    "math",
    "list_item",
    "multiple_choice_block",
    "multiple_choice_option",
    "section_header",
    "equation_number",
    "table",
    "simple_cell",
    "complex_cell",
    "table_row",
    "table_column",
    "form_field",
    "figure_label",
]
CONTAINER_TYPES = ["column", "container", "group", "region", "block"]
DROP_TYPES = ["page_info"]
FIGURE_TYPES = ["diagram", "chart"]
CONTINUE_SUBTYPES = ["continues_line_space", "continues_line_no_space", "continues_line_newline"]
