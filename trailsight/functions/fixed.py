"""Domains, labels, codes and limits the results depend on."""

# Published regions: key -> country name stored on the item.
REGIONS = {
    "china": "China",
    "taiwan": "Taiwan",
    "hong-kong": "Hong Kong",
    "macao": "Macao",
}
REGION_NAMES = {
    "china": "中国大陆",
    "taiwan": "台湾",
    "hong-kong": "香港",
    "macao": "澳门",
}
ALLOWED_COUNTRIES = ("China", "Hong Kong", "Taiwan", "Macao")

# Item status codes; NULL counts as 0.
STATUS_LIVE = 0
STATUS_ARCHIVED = 2
STATUS_DELETED = 404

EVENT_TYPES = (6, 13, 3653)
TYPE_LABELS = {
    2: "Tradition",
    3: "Multi",
    4: "Virtual",
    5: "Letterbox",
    6: "Event",
    8: "Mystery",
    11: "Webcam",
    12: "Locationless",
    13: "CITO",
    137: "Earthcache",
    1858: "Wherigo",
    3653: "Community Celebration Event",
}
TYPE_KEYS = {
    "tradition": 2,
    "multi": 3,
    "virtual": 4,
    "letterbox": 5,
    "mystery": 8,
    "webcam": 11,
    "locationless": 12,
    "earthcache": 137,
    "wherigo": 1858,
}

RANGES = ("30d", "ytd", "active", "all")
DT_VALUES = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0)

FOUND = "Found it"
ATTENDED = "Attended"
DELETED_VISIT = "deleted"
DELETED_OWNER = "[DELETED_USER]"
DELETED_GUID = "deleted"
MISSING_GUID = "no guid"

PLAYER_LIMIT = 50
CITY_LIMIT = 30
ITEM_LIMIT = 50
TOP_PER_CELL = 5
SUSPICIOUS_SHARE = 0.01
PAGE_CAP = 10_000
DETAILS_PER_ITEM = 5
MIN_VISITS_FOR_CANDIDATE = 10

# Crawled boxes: (max latitude, min longitude, min latitude, max longitude).
CRAWL_BOXES = (
    (55.0, 72.0, 36.0, 137.0),
    (36.0, 72.0, 17.0, 120.75),
    (31.25, 120.75, 17.0, 137.0),
    (36.0, 120.75, 31.25, 134.96875),
)

COUNTRY_SUBTITLES = {
    "China": "中国",
    "Taiwan": "台湾",
    "Hong Kong": "香港",
    "Macao": "澳门",
}
# Province by the first two digits of a city id.
PROVINCES = {
    "11": "北京市",
    "12": "天津市",
    "13": "河北省",
    "14": "山西省",
    "15": "内蒙古自治区",
    "21": "辽宁省",
    "22": "吉林省",
    "23": "黑龙江省",
    "31": "上海市",
    "32": "江苏省",
    "33": "浙江省",
    "34": "安徽省",
    "35": "福建省",
    "36": "江西省",
    "37": "山东省",
    "41": "河南省",
    "42": "湖北省",
    "43": "湖南省",
    "44": "广东省",
    "45": "广西壮族自治区",
    "46": "海南省",
    "50": "重庆市",
    "51": "四川省",
    "52": "贵州省",
    "53": "云南省",
    "54": "西藏自治区",
    "61": "陕西省",
    "62": "甘肃省",
    "63": "青海省",
    "64": "宁夏回族自治区",
    "65": "新疆维吾尔自治区",
}
DIRECT_ADMIN_CITIES = {
    "北京市": "北京市",
    "北京": "北京市",
    "上海市": "上海市",
    "上海": "上海市",
    "天津市": "天津市",
    "天津": "天津市",
    "重庆市": "重庆市",
    "重庆": "重庆市",
}
CONSTANT_CITIES = {"Hong Kong": "香港", "Macao": "澳门"}
TAIWAN_COUNTIES = (
    "連江縣", "金門縣", "宜蘭縣", "彰化縣", "南投縣", "雲林縣", "屏東縣", "臺東縣",
    "花蓮縣", "澎湖縣", "基隆市", "新竹市", "臺北市", "新北市", "臺中市", "臺南市",
    "桃園市", "苗栗縣", "新竹縣", "嘉義市", "嘉義縣", "高雄市",
)
US_STATES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut",
    "Delaware", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa",
    "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan",
    "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada",
    "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina",
    "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island",
    "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Vermont",
    "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming",
)

DEFAULT_AVATAR = "https://www.geocaching.com/images/default_avatar.png"

# Patterns (Java regular expression syntax).
AVATAR_PATTERNS = (
    r"""(?is)profile-image-wrapper.*?url\((?:'|")?(https://img\.geocaching\.com/user/square250/[^'")]+?\.(?:jpg|png)(?:\?[^'")]*)?)(?:'|")?\)""",
    r"""(?i)(https://img\.geocaching\.com/user/square250/[^'"\s<>)]*?\.(?:jpg|png)(?:\?[^'"\s<>)]*)?)""",
)
AVATAR_VALID = r"(?i)^https://img\.geocaching\.com/user/square250/.+\.(?:jpg|png)(?:\?.*)?$"
FTF_MARKER = r"(?iU)[\{\[\(（]\s*\*?\s*ftf\s*\*?\s*[\}\]\)）]"
JOINED_PATTERNS = (
    r"""(?is)<span\b[^>]*\bid=["']ctl00_ProfileHead_ProfileHeader_lblMemberSinceDate["'][^>]*>\s*Joined\s*(.*?)\s*</span>""",
    r"""(?is)<span\b[^>]*\bid=["'][^"']*lblMemberSinceDate["'][^>]*>\s*Joined\s*(.*?)\s*</span>""",
)
MEMBER_PATTERN = (
    r"""(?is)<span\b[^>]*\bid=["']ctl00_ProfileHead_ProfileHeader_lblMemberName["'][^>]*>(.*?)</span>"""
)
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"
CONTEXT_PATTERNS = (
    r"(?is)(.{0,120}lblMemberSinceDate.{0,180})",
    r"(?is)(.{0,120}(?:lblMemberSinceDate|Joined|Member Since|memberSince|dateJoined).{0,180})",
)
CONTEXT_WORDS = r"(?i)lblMemberSinceDate|Joined|Member Since|memberSince|dateJoined"
PROFILE_MARKERS = (
    "lblMemberSinceDate",
    "ctl00_ProfileHead_ProfileHeader_lblMemberName",
    "Joined",
    "dateJoined",
    "UserProfile",
    "This user's profile is private",
    "Sorry, the requested user profile was not found",
    "Page Not Found",
)
FIND_COUNT_PATTERN = r"(?is)profile-stats.*?(\d[\d,]*)\s*finds?"
ITEM_SPAN_PATTERN = r"""(?s)<span\s+class="small">(.*?)</span>"""
ITEM_CODE_PATTERN = r"^GC[A-Z0-9]+$"
OWNER_GUID_PATTERN = r"(?i)/p/\?guid=([a-f0-9-]+)"
JSON_LD_PATTERN = r"""(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>"""
JS_POSITION_PATTERN = r"(?i)var\s+lat\s*=\s*([\d.]+)\s*,\s*lng\s*=\s*([\d.]+)"
BUILD_PATTERNS = (
    r"/_next/data/release-([^/]+)/en/play/map\.json",
    r'"buildId":"(release-[^"]+)"',
    r'"buildId":"([^"]+)"',
    r"sentry-release=release-([0-9.]+)",
    r"release-([0-9]{8}\.[0-9]+\.[0-9]+)",
)
ARCHIVED_PATTERNS = (
    r'(?i)id="ctl00_ContentBody_archivedMessage"',
    r"(?i)This cache has been archived",
    r'(?i)id="ctl00_ContentBody_lockedMessage"',
    r"(?i)This cache has been locked",
)
PREMIUM_ONLY_PATTERN = r"(?i)<title>[^<]*Premium Member Only Cache"
LOGIN_URL_MARKERS = ("/account/signin", "/login", "signin?", "returnurl=", "next-auth")
LOGIN_PAGE_MARKERS = (
    "<title>log in",
    "<title>sign in",
    "create your free account",
    "sign in to continue",
    "next-auth",
    "account/signin",
)
PUBLIC_USER_PATTERN = r"userInfo\s*=\s*\{\s*ID\s*:\s*0\s*\}"
PAGE_INFO_PATTERN = (
    r'"pageInfo"\s*:\s*\{\s*"idx"\s*:\s*1,\s*"size"\s*:\s*(\d+),\s*"totalRows"\s*:\s*(\d+)'
)
# Date layouts tried in this order.
JOINED_FORMATS = (
    "M/d/yyyy",
    "d/M/yyyy",
    "yyyy-M-d",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "M.d.yyyy",
    "d.M.yyyy",
    "yyyy. M. d.",
    "yyyy.M.d.",
    "yyyy. M. d",
    "yyyy.M.d",
)
REPORT_VERSION = "1.0.0"
