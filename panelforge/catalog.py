"""The rule tables of the Vietnamese news path.

They must equal the published vocabulary for equal labels, so they are stated as they are, in their
natural order (order is priority). Every operator takes its table as an argument.
"""

from __future__ import annotations

# Event types of the short classifier, in priority order.
EVENT_TYPE_RULES = {
    "accident": [
        "tai nạn", "va chạm", "lật xe", "đâm vào", "đụng nhau", "tai nạn giao thông", "xe máy đâm", "ôtô đâm",
        "xe tải đâm", "húc vào", "tông vào", "tông nhau", "lao vào",
    ],
    "flood": ["ngập", "ngập lụt", "ngập sâu", "mưa lớn gây ngập", "nước ngập", "ngập úng", "triều cường ngập"],
    "event": [
        "lễ hội", "hội chợ", "sự kiện", "biểu diễn", "countdown", "lễ kỷ niệm", "đại hội", "marathon", "giải chạy",
        "chương trình biểu diễn", "lễ khai mạc",
    ],
    "road_work": [
        "sửa đường", "thi công", "rào chắn", "cấm đường", "phân luồng", "nâng cấp đường", "mở rộng đường",
        "xây dựng cầu", "thi công hầm", "cải tạo đường", "đào đường", "láng nhựa",
    ],
    "weather": ["bão", "gió mạnh", "sương mù dày", "mưa lớn", "mưa đá", "lũ lụt", "lốc xoáy", "áp thấp nhiệt đới"],
}

# Severity words of the 0–3 scale, worst first.
SEVERITY_WORDS = {
    3: [
        "chết người", "tử vong", "thiệt mạng", "nguy kịch", "tắc nghiêm trọng", "kẹt nhiều giờ", "tê liệt giao thông",
        "ùn tắc nghiêm trọng", "ách tắc toàn tuyến",
    ],
    2: [
        "ùn tắc kéo dài", "phương tiện dồn ứ", "ngập sâu", "kẹt xe dài", "ùn ứ kéo dài", "tắc đường dài",
        "ùn tắc hàng km", "cấm đường hoàn toàn",
    ],
    1: [
        "ùn ứ cục bộ", "lưu thông chậm", "di chuyển khó khăn", "lưu thông ảnh hưởng", "ùn nhẹ", "chậm lại",
        "phân luồng", "cấm một chiều",
    ],
}

# Event categories of the long classifier, in priority order.
CATEGORY_RULES = {
    "accident": ["tai nạn", "va chạm", "tông", "đâm", "lật xe", "bị cán", "tử vong", "bị thương"],
    "congestion": ["ùn tắc", "ùn ứ", "kẹt xe", "tắc đường", "tắc kéo dài", "ách tắc"],
    "flood": ["ngập", "ngập úng", "ngập lụt", "nước dâng"],
    "weather_disruption": ["mưa lớn", "mưa rất to", "bão", "gió mạnh", "sạt lở", "trơn trượt", "sương mù"],
    "roadwork_active": ["thi công", "rào chắn", "phân luồng", "cấm đường", "đóng đường", "sửa đường"],
    "airport": ["sân bay", "đường băng", "chuyến bay", "hạ cánh", "cảng hàng không"],
    "public_transport": ["xe buýt", "buýt", "metro", "đường sắt đô thị", "tàu điện", "bến xe"],
    "enforcement": ["csgt", "xử phạt", "nồng độ cồn", "tước gplx", "camera phạt nguội", "đăng kiểm"],
    "planned_event": ["lễ hội", "concert", "sự kiện", "diễu hành", "chạy marathon", "cấm đường phục vụ"],
    "roadwork_planned": ["sắp thi công", "sẽ phân luồng", "chuẩn bị rào chắn", "dự kiến thi công"],
    "infrastructure_planning": [
        "quy hoạch", "đề xuất", "sắp mở rộng", "dự án", "đầu tư", "khởi công", "thẩm định", "thi tuyển kiến trúc",
    ],
}
PLANNING_WORDS = [
    "quy hoạch", "đề xuất", "sắp mở rộng", "dự án", "đầu tư", "khởi công", "thẩm định", "thi tuyển kiến trúc",
    "dự kiến", "chuẩn bị", "sắp thông xe", "sắp về đích",
]
ACTIVE_ROADWORK_WORDS = [
    "đang thi công", "thi công", "phân luồng", "cấm đường", "hạn chế phương tiện", "rào chắn", "đóng đường",
    "sửa đường", "sửa cầu", "lộ trình thay thế", "cải tạo",
]
INFRASTRUCTURE_WORDS = ["đường", "cầu", "cao tốc", "quốc lộ", "vành đai", "hạ tầng", "nút giao"]
PLANNED_ROADWORK_WORDS = ["sắp thi công", "dự kiến thi công", "chuẩn bị rào chắn"]

EVENT_RULES = {
    "categories": CATEGORY_RULES,
    "planning": PLANNING_WORDS,
    "active_roadwork": ACTIVE_ROADWORK_WORDS,
    "infrastructure": INFRASTRUCTURE_WORDS,
    "planned_roadwork": PLANNED_ROADWORK_WORDS,
    "fatal": ["tử vong", "chết", "nhiều người bị thương", "19 người bị thương", "thiệt mạng"],
    "severe": ["ùn tắc kéo dài", "va chạm liên hoàn", "mưa rất to", "ngập úng", "ngập sâu", "sạt lở"],
    "moderate": ["tai nạn", "va chạm", "thi công", "phân luồng", "trơn trượt", "cấm đường"],
    "early_plan": ["đề xuất", "quy hoạch", "sắp mở rộng"],
    "off_topic": ["tài chính", "ngân hàng", "thi tuyển kiến trúc", "đề xuất"],
}

# Base relevance, event length in hours and the categories a model may use.
RELEVANCE_BASE = {
    "accident": 0.95,
    "congestion": 0.95,
    "flood": 0.9,
    "weather_disruption": 0.85,
    "roadwork_active": 0.85,
    "airport": 0.65,
    "public_transport": 0.6,
    "enforcement": 0.55,
    "planned_event": 0.55,
    "roadwork_planned": 0.35,
    "infrastructure_planning": 0.25,
}
DURATION_HOURS = {
    "roadwork_active": 24,
    "roadwork_planned": 24,
    "infrastructure_planning": 24,
    "flood": 6,
    "weather_disruption": 6,
    "planned_event": 6,
}
DEFAULT_DURATION_HOURS = 3
ACTIVE_CATEGORIES = [
    "accident", "congestion", "flood", "weather_disruption", "roadwork_active", "airport", "public_transport",
    "enforcement", "planned_event",
]
MODEL_RELEVANCE = 0.55

# Category hints of the raw news table (several may apply).
HINT_RULES = {
    "accident": ["tai nạn", "va chạm", "tông", "đâm", "cán", "tử vong", "bị thương", "liên hoàn"],
    "congestion": ["ùn tắc", "kẹt xe", "ùn ứ"],
    "roadwork": ["thi công", "phân luồng", "sửa đường", "mở rộng", "sửa cầu", "xuống cấp"],
    "weather": ["mưa lớn", "ngập úng", "trơn trượt", "không khí lạnh", "ngập sâu", "giông", "sạt lở"],
    "airport": ["sân bay", "đường băng", "cảng hàng không"],
    "enforcement": ["csgt", "xử phạt", "nồng độ cồn", "gplx"],
    "public_transport": ["xe buýt", "buýt", "metro", "đường sắt", "tàu hỏa"],
    "planned_event": ["diễn đàn", "lễ hội", "hội báo", "đại biểu"],
    "possible_unrelated": ["ngân hàng", "tài chính", "sim", "thuê bao", "trái cây", "lễ phục"],
}

# City aliases in match order, one table for raw news and one for events. Plain spellings follow by folding the accents.
NEWS_CITY_ALIASES = {
    "hanoi": [
        "hà nội", "thường tín", "nguyễn chí thanh", "la thành", "nguyễn chánh", "nội bài", "mỹ đình", "pháp vân",
        "cầu giẽ",
    ],
    "hcmc": [
        "tp hcm", "tp.hcm", "tphcm", "tp hồ chí minh", "hồ chí minh", "sài gòn", "thủ thiêm", "cầu sài gòn",
        "tân sơn nhất", "cộng hòa", "hàng xanh", "cầu phú mỹ", "điện biên phủ", "nguyễn duy trinh",
    ],
    "haiphong": ["hải phòng", "cát bi"],
    "danang": ["đà nẵng"],
    "cantho": ["cần thơ"],
    "hue": ["huế", "phú bài"],
    "dongnai": ["đồng nai", "long thành", "dầu giây", "quốc lộ 51"],
    "lamdong": ["lâm đồng", "đạ huoai", "cư jút"],
    "hatinh": ["hà tĩnh", "bãi vọt", "hàm nghi"],
    "quangninh": ["quảng ninh", "hạ long", "móng cái", "cẩm phả"],
    "hungyen": ["hưng yên", "nguyễn văn linh"],
    "ninhbinh": ["ninh bình", "hoa lư"],
    "quangtri": ["quảng trị", "cam lộ", "la sơn", "đông hà"],
    "khanhhoa": ["khánh hòa", "nha trang"],
    "tayninh": ["tây ninh"],
    "daklak": ["đắk lắk", "daklak", "buôn ma thuột"],
    "gialai": ["gia lai", "an khê", "tô na"],
    "laocai": ["lào cai"],
    "bacninh": ["bắc ninh"],
    "nghean": ["nghệ an"],
    "thanhhoa": ["thanh hóa"],
    "quangngai": ["quảng ngãi"],
    "vungtau": ["vũng tàu", "bà rịa"],
    "binhduong": ["bình dương", "thủ dầu một"],
    "camau": ["cà mau"],
    "angiang": ["an giang", "núi sam", "châu đốc"],
    "dongthap": ["đồng tháp"],
}
EVENT_CITY_ALIASES = {
    "hanoi": [
        "hà nội", "nguyễn chí thanh", "la thành", "nguyễn chánh", "thủ đô", "nội bài", "vành đai 3", "hoàn kiếm",
        "mỹ đình", "thường tín", "pháp vân", "cầu giẽ", "nguyễn văn huyên", "nguyễn xuân linh",
    ],
    "hcmc": [
        "tp.hcm", "tp hcm", "tphcm", "hồ chí minh", "sài gòn", "thủ thiêm", "cầu sài gòn", "tân sơn nhất", "quận 1",
        "bến thành", "cộng hòa", "hàng xanh", "cầu phú mỹ", "cầu bình lợi", "điện biên phủ", "nguyễn duy trinh",
        "an khánh", "sala", "bùi viện",
    ],
    "danang": ["đà nẵng"],
    "haiphong": ["hải phòng", "cát bi"],
    "cantho": ["cần thơ"],
    "hue": ["huế", "phú bài"],
    "dongnai": ["đồng nai", "long thành", "dầu giây", "quốc lộ 51"],
    "lamdong": ["lâm đồng", "đà lạt", "đạ huoai"],
    "hatinh": ["hà tĩnh", "bãi vọt", "hàm nghi"],
    "quangninh": ["quảng ninh", "hạ long", "móng cái", "cẩm phả"],
    "hungyen": ["hưng yên", "nguyễn văn linh"],
    "ninhbinh": ["ninh bình", "hoa lư"],
    "quangtri": ["quảng trị", "cam lộ", "la sơn", "đông hà"],
    "khanhhoa": ["khánh hòa", "nha trang"],
    "tayninh": ["tây ninh"],
    "daklak": ["đắk lắk", "daklak", "buôn ma thuột"],
    "gialai": ["gia lai", "an khê", "tô na"],
    "laocai": ["lào cai"],
    "bacninh": ["bắc ninh"],
    "nghean": ["nghệ an"],
    "thanhhoa": ["thanh hóa"],
    "quangngai": ["quảng ngãi"],
    "vungtau": ["vũng tàu", "bà rịa"],
    "binhduong": ["bình dương", "thủ dầu một"],
    "camau": ["cà mau"],
    "angiang": ["an giang", "núi sam", "châu đốc"],
    "dongthap": ["đồng tháp"],
}

# Districts and main roads a text may name.
GAZETTEER = [
    "Hoàn Kiếm", "Ba Đình", "Đống Đa", "Hai Bà Trưng", "Hoàng Mai", "Thanh Xuân", "Cầu Giấy", "Tây Hồ", "Long Biên",
    "Nam Từ Liêm", "Bắc Từ Liêm", "Hà Đông", "Sơn Tây", "Đan Phượng", "Hoài Đức", "Quốc Oai", "Thạch Thất", "Chương Mỹ",
    "Thanh Oai", "Thường Tín", "Phú Xuyên", "Ứng Hòa", "Mỹ Đức", "Mê Linh", "Sóc Sơn", "Đông Anh", "Gia Lâm", "Ba Vì",
    "Quận 1", "Quận 2", "Quận 3", "Quận 4", "Quận 5", "Quận 6", "Quận 7", "Quận 8", "Quận 9", "Quận 10", "Quận 11",
    "Quận 12", "Bình Thạnh", "Gò Vấp", "Phú Nhuận", "Tân Bình", "Tân Phú", "Bình Tân", "Thủ Đức", "Củ Chi", "Hóc Môn",
    "Bình Chánh", "Nhà Bè", "Cần Giờ",
    "Nguyễn Trãi", "Khuất Duy Tiến", "Lê Văn Lương", "Tố Hữu", "Hoàng Quốc Việt", "Xuân Thủy", "Kim Mã", "Liễu Giai",
    "Đội Cấn", "Phan Đình Phùng", "Trần Phú", "Giải Phóng", "Đại La", "Minh Khai", "Trường Chinh", "Nguyễn Xiển",
    "Vành Đai 3", "Cầu Nhật Tân", "Cầu Long Biên", "Cầu Chương Dương", "Cầu Thăng Long", "Hầm Kim Liên",
    "Đường Vành Đai",
    "Điện Biên Phủ", "Võ Văn Kiệt", "Hùng Vương", "Nguyễn Văn Linh", "Mai Chí Thọ", "Phạm Văn Đồng", "Xa Lộ Hà Nội",
    "Quốc lộ 1", "Đại lộ Đông Tây", "Nguyễn Hữu Thọ", "Lê Văn Việt", "Cầu Sài Gòn", "Hầm sông Sài Gòn",
    "Cầu Bình Triệu",
]
PLACE_CITIES = {
    "Hà Nội": ["hà nội", "ha noi", "thủ đô"],
    "TP.HCM": ["tp.hcm", "tp hcm", "hcm", "thành phố hồ chí minh", "sài gòn", "saigon"],
}

# Words that make a feed item or a listing link relevant.
TRAFFIC_WORDS = [
    "tai nạn", "va chạm", "lật xe", "đâm vào", "đụng nhau", "ngập", "ngập lụt", "ngập sâu", "mưa lớn", "sửa đường",
    "thi công", "rào chắn", "cấm đường", "phân luồng", "ùn tắc", "ùn ứ", "kẹt xe", "tắc đường", "tắc nghiêm trọng",
    "lễ hội", "hội chợ", "sự kiện", "biểu diễn", "bão", "gió mạnh", "sương mù", "tai nạn giao thông", "ách tắc",
]
BLOCKED_TITLES = [
    "giao thông", "an toàn giao thông", "giao thông 24h", "chuyện dọc đường", "thời sự", "đô thị", "xe++",
    "trang nhất",
]

# Folded stopwords of the title comparison.
TITLE_STOPWORDS = [
    "va", "cua", "la", "trong", "tren", "duoi", "den", "tu", "theo", "hoac", "nhung", "cac", "mot", "hai", "ba",
    "bon", "nam", "co", "khong", "duoc", "da", "dang", "se", "rat", "khi", "nhu", "the", "nay", "do", "voi", "ve",
    "cho", "boi", "sau", "truoc",
]

# Patterns for districts (in order) and road names.
DISTRICT_PATTERNS = [
    r"(?U)\bquận\s+[0-9a-zà-ỹ]+",
    r"(?U)\bhuyện\s+[a-zà-ỹ\s]{2,25}",
    r"(?U)\bthành phố\s+[a-zà-ỹ\s]{2,25}",
    r"(?U)\btp\.?\s*[a-zà-ỹ\s]{2,25}",
]
ROAD_PATTERN = (
    r"(?iuU)\b((?:đường|phố|cầu|cao tốc|quốc lộ|tỉnh lộ|đại lộ|vành đai|nút giao|hầm|sân bay|ga)\s+"
    r"[A-ZÀ-Ỹ0-9][A-Za-zÀ-ỹ0-9.\-/]*(?:\s+[A-ZÀ-Ỹ0-9][A-Za-zÀ-ỹ0-9.\-/]*){0,6})"
)

# Words that make a listing link relevant.
LINK_WORDS = [
    "giao thông", "ùn tắc", "kẹt xe", "tai nạn", "va chạm", "cao tốc", "đường bộ", "đường sắt", "đường thủy",
    "hàng không", "cầu", "đường", "csgt", "atgt", "xe", "bus", "buýt", "metro", "phân luồng", "đăng kiểm", "sân bay",
    "nút giao", "vận tải",
]
