"""Default word lists, labels and rule tables.

Every operator takes these as parameters; the values here are only the
defaults.
"""

# Must equal the published rules for equal results. ------------

HIGH_KEYWORDS = [
    "hypertension", "blood pressure", "sarcopenia", "muscle", "protein",
    "cognitive", "dementia", "alzheimer", "diabetes", "glucose", "insulin",
    "osteoporosis", "bone density", "fracture", "fall", "sleep", "insomnia",
    "gut microbiome", "longevity", "aging", "elderly", "older adults",
    "frailty", "polypharmacy", "deprescribing",
]
MEDIUM_KEYWORDS = [
    "exercise", "physical activity", "nutrition", "diet", "supplement",
    "vitamin", "mineral", "omega-3", "coenzyme", "coq10",
    "blood pressure monitor", "wearable", "cgm", "continuous glucose",
]
HIGH_POINTS = 10
MEDIUM_POINTS = 5
FOCUS_TERM = "japan"
FOCUS_POINTS = 10
RECENCY_DAYS = 30

POSITIVE_WORDS = [
    "benefit", "improve", "reduce", "prevent", "effective", "protect",
    "decrease", "lower", "positive", "reduces", "improves", "prevents",
]
NEGATIVE_WORDS = [
    "harm", "increase", "risk", "worsen", "ineffective", "no effect",
    "no benefit", "raise", "elevate", "negative", "increases", "worsens",
    "fails",
]

# (substring of a tag, category code), first match wins
TAG_RULES = [
    ("hypertension", "heart"), ("blood pressure", "heart"),
    ("sarcopenia", "muscle"), ("muscle", "muscle"), ("protein", "muscle"),
    ("cognitive", "brain"), ("dementia", "brain"), ("alzheimer", "brain"),
    ("diabetes", "sugar"), ("glucose", "sugar"), ("insulin", "sugar"),
    ("osteoporosis", "muscle"), ("bone", "muscle"), ("fracture", "muscle"),
    ("sleep", "sleep"), ("insomnia", "sleep"),
    ("gut microbiome", "gut"), ("longevity", "gut"), ("aging", "gut"),
    ("eye", "eyes"), ("vision", "eyes"),
]
DEFAULT_CATEGORY = "health"

# (category code, display name, icon)
CATEGORY_LABELS = [
    ("heart", "心臓・血管", "❤️"),
    ("brain", "脳・認知", "🧠"),
    ("muscle", "筋肉・骨", "💪"),
    ("sugar", "血糖・脂質", "🍚"),
    ("check", "検診・予防", "🔍"),
    ("sleep", "睡眠", "😴"),
    ("gut", "腸内フローラ", "🦠"),
    ("eyes", "目の健康", "👁️"),
]
DEFAULT_LABEL = ("健康", "📝")

# strongest evidence first
EVIDENCE_ORDER = ["meta-analysis", "guideline", "RCT"]

# record used when a generated column cannot be repaired
ERROR_COLUMN = {
    "title": "生成エラー",
    "lead": "記事の生成に失敗しました",
    "body_html": "<p>記事の生成に失敗しました。後でもう一度お試しください。</p>",
    "action_items": ["後でもう一度お試しください"],
    "source_citation": "",
    "disclaimer": "本記事は一般的な健康情報の提供を目的としており、医師の診断・治療に代わるものではありません。健康に関する判断は必ず専門医にご相談ください。",
    "affiliate_keywords": [],
}

# ----------------------------------------------------------------------------
