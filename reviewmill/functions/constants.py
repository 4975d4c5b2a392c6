"""Fixed values the results depend on. Everything here is data, not logic."""

# --- fixed values: emoji code-point ranges (first, last) -------------------
EMOJI_RANGES = [
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F700, 0x1F77F),
    (0x1F780, 0x1F7FF),
    (0x1F800, 0x1F8FF),
    (0x1F900, 0x1F9FF),
    (0x1FA00, 0x1FA6F),
    (0x1FA70, 0x1FAFF),
    (0x2600, 0x26FF),
    (0x2700, 0x27BF),
]

# --- fixed values: part-of-speech selections -------------------------------
CONTENT_POS = ["Noun", "Verb", "Adjective", "Adverb"]
EXPRESSIVE_POS = ["Adjective", "Verb", "Exclamation", "Adverb"]
LEMMA_POS = ["Noun", "Adjective", "Verb"]
PREDICATE_POS = ["Adjective", "Verb"]

# --- fixed values: sentiment class names, in tie-break order ---------------
CLASSES = ["Positive", "Negative", "Neutral"]
CLASSES_KO = {"Positive": "긍정", "Negative": "부정", "Neutral": "중립"}

# --- fixed values: raw review table, positional English and Korean names ---
REVIEW_COLUMNS = [
    "university_name",
    "shop_name",
    "shop_avg_rating",
    "reviewer_review_count",
    "review_text",
    "review_date",
    "shop_visit_count",
    "tags",
]
REVIEW_COLUMNS_KO = [
    "대학교 이름",
    "가게 이름",
    "가게 평균 평점",
    "리뷰어 리뷰수",
    "리뷰 텍스트",
    "리뷰 날짜",
    "가게 방문수",
    "태그들",
]

# --- fixed values: defaults for missing fields -----------------------------
NO_REVIEW = "리뷰 없음"
NO_TAGS = "태그 없음"
HEADER_MARK = "대학교 이름"

# --- fixed values: ordered tag phrase replacements (order matters) ---------
TAG_REPLACEMENTS = [
    ("청결해요", "청결"),
    ("특별한 메뉴", "특별한메뉴"),
    ("친절해요", "친절"),
    ("커피가 맛있어요", "커피"),
    ("인테리어가 멋져요", "인테리어"),
    ("사진이 잘 나와요", "사진"),
    ("대화하기 좋아요", "대화하기"),
    ("아늑해요", "아늑함"),
    ("차분한 분위기에요", "차분한분위기"),
    ("디저트가 맛있어요", "디저트"),
    ("특별한메뉴가 있어요", "특별한 메뉴"),
    ("음료가 맛있어요", "음료"),
    ("집중하기 좋아요", "집중"),
    ("가성비가 좋아요", "가성비"),
    ("빵이 맛있어요", "빵"),
    ("매장이 청결", "청결"),
    ("화장실이 깨끗해요", "화장실이 깨끗해요"),
]

# --- fixed values: punctuation unification pairs ---------------------------
PUNCTUATION_PAIRS = [
    ("·", "/"),
    ("․", "/"),
    ("ㆍ", "/"),
    ("･", "/"),
    ("～", "~"),
    ("❑", "-"),
    ("‘", "'"),
    ("’", "'"),
    ("“", '"'),
    ("”", '"'),
    ("「", "<"),
    ("」", ">"),
]

# --- fixed values: topic dictionary, topics in priority order --------------
FOOD_TOPICS = [
    ("디저트", ["크림", "초코", "딸기", "빙수", "샌드위치", "타르트", "스콘", "와플", "푸딩", "파르페", "마카롱"]),
    ("음료", ["아메리카노", "원두", "밀크", "요거트", "에스프레소"]),
    ("특징 (단맛)", ["달달", "민트", "초코"]),
    ("특징 (짠맛)", ["소금", "치즈"]),
    ("특수음식", ["타르트", "베이글", "샌드위치", "브런치"]),
    ("선물용", ["선물", "예약", "구매"]),
]
OTHER_TOPIC = "기타"

# --- fixed values: extra stop words used with the top-word report ----------
CUSTOM_STOP_WORDS = [
    "진짜", "정말", "항상", "완전", "최고", "기분", "생각", "추천", "직접", "이용",
    "커피", "카페", "디저트", "사장", "방문", "음료", "매장", "메뉴", "가격", "종류",
    "건대", "홍대", "서울대", "명지대", "경희대", "한성대", "중앙대", "왕십리", "성수",
    "친구", "사람", "자리", "사진", "오늘", "학교", "학생", "가게", "가성", "공차", "공간",
    "국민대", "근처", "대화", "동네", "리뷰", "맛집", "보고", "서비스", "스터디", "선생님",
    "삼육대", "안산", "안성", "아침", "직원", "조치원", "주문", "처음", "포장", "회사",
    "인테리어", "음악", "느낌", "자주", "역곡", "강서", "합심", "성신여대", "광운대", "충무로",
    "경의선", "신촌", "이대", "올림픽", "회기", "숭실대", "영통", "모현",
]

# --- fixed values: café ranking categories ---------------------------------
# direction +1 = descending ("high"), -1 = ascending ("low"), in the key order
# average rating, total visits, total reviewers
RANKING_CATEGORIES = [
    ("high_rating_high_visit_high_review_cafes", (1, 1, 1)),
    ("high_rating_high_visit_low_review_cafes", (1, 1, -1)),
    ("high_rating_low_visit_high_review_cafes", (1, -1, 1)),
    ("high_rating_low_visit_low_review_cafes", (1, -1, -1)),
    ("low_rating_high_visit_high_review_cafes", (-1, 1, 1)),
    ("low_rating_high_visit_low_review_cafes", (-1, 1, -1)),
    ("low_rating_low_visit_high_review_cafes", (-1, -1, 1)),
    ("low_rating_low_visit_low_review_cafes", (-1, -1, -1)),
]
