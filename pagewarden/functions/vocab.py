"""Fixed values of the domain: vocabularies, limits and schedules."""

from __future__ import annotations

# Tags of the registry as (code, name), by kind.
CATEGORIES = [
    ("000", "未分類"), ("001", "住民向け情報"), ("002", "妊娠・出産"), ("003", "子育て"), ("004", "保育"), ("005", "学校教育"),
    ("006", "結婚・離婚"), ("007", "引越し・住まい"), ("008", "就職・退職"), ("009", "高齢者支援"), ("010", "在宅介護"),
    ("011", "施設介護"), ("012", "ご不幸"), ("013", "戸籍・住民票・印鑑登録等"), ("014", "税"), ("015", "国民健康保険"),
    ("016", "国民年金"), ("017", "水道・ガス・電気"), ("018", "交通"), ("019", "駐輪・駐車"), ("020", "都市計画"),
    ("021", "ごみ・環境保全"), ("022", "食品・衛生"), ("023", "ペット・動物"), ("024", "生活困窮者支援"), ("025", "障がい者支援"),
    ("026", "消費生活"), ("027", "健康・医療"), ("028", "文化・スポーツ・生涯学習"), ("029", "市民活動・コミュニティ"),
    ("030", "防災・災害"), ("031", "防犯・犯罪"), ("032", "救急・消防"),
]
TARGETS = [
    ("000", "未分類"), ("086", "妊産婦"), ("087", "子育て中"), ("088", "ひとり親"), ("089", "未熟児"), ("090", "障害児"),
    ("091", "遺児"), ("092", "学生"), ("093", "独身者"), ("094", "求職者"), ("095", "就業者"), ("096", "高齢者"),
    ("097", "介護中"), ("098", "障がい者"), ("099", "遺族"), ("100", "ペット"), ("101", "被災者"), ("102", "犯罪被害者"),
]
CONTENTS = [("000", "未分類"), ("077", "届出"), ("078", "申請"), ("079", "支給・支援"), ("080", "イベント"), ("081", "施設"), ("082", "情報啓発"), ("083", "地図")]
TAGS = {"category": CATEGORIES, "target": TARGETS, "content": CONTENTS}

# What URLs are allowed and how they are normalised.
SCHEMES = ("https", "http")
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid")
SITE_RULES = {"www.city.koganei.lg.jp": "/smph/"}
PAGE_EXTENSIONS = ("html", "htm", "shtml", "php", "aspx", "jsp")
HTML_EXTENSIONS = ("html", "htm")
FORM_PATH = "/cgi-bin/"
URL_PATTERN = r"https?://[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=%]+"
TRAILING_MARKS = ".,;:()'"
PARENT_PATTERN = r"^(https?://[^/]+/(?:.*?/)?)[^/]*/?$"

# Limits.
MAX_RELATED = 3
MIN_SCORE, MIN_NAME_CHARS, MAX_CANDIDATES = 0.6, 4, 3
MAX_REDIRECTS, PAGE_LIMIT, ROBOTS_LIMIT = 5, 10 << 20, 500 << 10
NOT_FOUND_LIMIT = 3
SAME_TARGET_PAGES = 3
UNUSABLE_STARTS = 5
PRIORITY_MAIN, PRIORITY_RELATED, PRIORITY_INDEX = 80, 70, 90
NOT_FOUND_TITLES = ("見つかりません", "存在しません", "not found")

# Revisit intervals in days (initial, least, most) by kind, and other waits.
DAY = 86_400
BOUNDS = {"page": (7, 3, 14), "pdf": (30, 14, 90), "deletion_candidate": (7, 3, 7), "blocked": (7, 7, 30), "gone_index": (90, 90, 90)}
MAX_RETRIES, FAILED_FINAL_DAYS, SKIPPED_HOST_DAYS, FULL_FETCH_DAYS = 2, 7, 1, 28
BACKOFF_FIRST_S, BACKOFF_MOST_S, JITTER_MS = 10, 600, 5000

# Pacing of a host in seconds.
PACE_LEAST_S, PACE_MOST_S, RETRY_AFTER_MOST_S = 2.0, 30.0, 600

# Alert thresholds.
SURGE_COUNT, SURGE_RATE, SURGE_TIMES = 5, 0.2, 2.0
CHANGE_COMPARED, CHANGE_RATE = 20, 0.5
LEASE_COUNT, LEASE_RATE = 10, 0.05

STATES = ("active", "deletion_candidate", "deleted", "moved")
DEAD = ("deleted", "deletion_candidate")
STATUSES = ("queued", "processing", "succeeded", "retry_wait", "failed_final", "blocked", "retired")
SOURCES = ("normalized", "declared", "redirect")  # weakest first

# Elements of a page by their part in the extraction.
EXTRACTOR_VERSION = 4
HIDDEN = ("script", "style", "noscript", "template")
CHROME, CHROME_MARKS = ("nav", "header", "footer", "aside"), ("localnavi", "lobgbox")
BLOCKS = tuple(
    "address article aside blockquote br caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr li main nav ol p pre section summary table td th tr ul option".split()
)

# How dates of updates are written.
DATE = r"(?:\d{4} *年 *\d{1,2} *月 *\d{1,2} *日|\d{4} *[/.\-] *\d{1,2} *[/.\-] *\d{1,2}|(?:令和|平成) *(?:\d{1,2}|元) *年 *\d{1,2} *月 *\d{1,2} *日)"
GAP = r"[\s:\]】)>]*"
UPDATED = rf"(?:最終更新日|更新日)時?{GAP}{DATE}|{DATE} *(?:最終)?更新"
PUBLISHED = rf"(?:掲載日|公開日|作成日|登録日)時?{GAP}{DATE}|{DATE} *(?:掲載|公開|作成)"
DATE_PARTS = r"(?:(令和|平成) *(\d{1,2}|元)|(\d{4})) *[年/.\-] *(\d{1,2}) *[月/.\-] *(\d{1,2})"
ERAS = {"令和": 2018, "平成": 1988}
