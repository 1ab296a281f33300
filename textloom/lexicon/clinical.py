"""The Vietnamese clinical instance of the rule tables.

Everything in this module is fixed values: types, word lists, cue lists, header
lists and patterns that results depend on.
"""

from __future__ import annotations

SYMPTOM, LAB_NAME, LAB_VALUE, DIAGNOSIS, DRUG = "TRIỆU_CHỨNG", "TÊN_XÉT_NGHIỆM", "KẾT_QUẢ_XÉT_NGHIỆM", "CHẨN_ĐOÁN", "THUỐC"
ENTITY_TYPES = [SYMPTOM, LAB_NAME, LAB_VALUE, DIAGNOSIS, DRUG]
ASSERTIONS = ["isNegated", "isFamily", "isHistorical"]
ASSERTED_TYPES = [SYMPTOM, DIAGNOSIS, DRUG]
CODED_TYPES = [DIAGNOSIS, DRUG]

# (kind, header phrases, default assertions, expected types), in order of precedence
SECTION_RULES = [
    ("drug_history", ["thuốc trước khi nhập viện", "thuốc trước nhập viện", "danh sách thuốc trước nhập viện", "xử trí thuốc"], ["isHistorical"], [DRUG]),
    ("diagnosis_history", ["bệnh lý mãn tính", "các bệnh lý mãn tính", "bệnh mãn tính", "các bệnh lý mạn tính", "tiền sử bệnh", "tiền sử bệnh nội khoa"], ["isHistorical"], [DIAGNOSIS]),
    ("symptom_current", ["triệu chứng hiện tại", "triệu chứng khi nhập viện", "lý do nhập viện", "bệnh sử", "tiền sử bệnh hiện tại"], [], [SYMPTOM]),
    ("lab_results", ["kết quả xét nghiệm", "xét nghiệm", "cận lâm sàng", "xét nghiệm máu", "công thức máu"], [], [LAB_NAME, LAB_VALUE]),
    ("diagnosis_current", ["chẩn đoán sơ bộ", "chẩn đoán", "đánh giá", "kết quả chẩn đoán hình ảnh", "kết quả hình ảnh"], [], [DIAGNOSIS]),
]
CLAUSE_SEPARATORS = ".;\n"
ANCHOR_CHARS, ANCHOR_TOKENS = 64, 8

DIAGNOSIS_PREFIXES = ["được chẩn đoán", "chẩn đoán sơ bộ", "mắc bệnh", "bệnh lý mãn tính:"]
SYMPTOM_TERMS = [
    "ho", "sốt", "đau bụng", "đau thượng vị", "ợ hơi", "tức ngực", "khó thở", "mệt mỏi", "buồn nôn", "nôn", "đờm xanh", "đờm", "đánh trống ngực", "tiêu chảy",
    "lo âu", "mất ngủ", "đau nhức", "táo bón", "ngất xỉu", "căng thẳng", "yếu", "vàng da", "ngứa", "vã mồ hôi", "chảy dịch", "giọng khàn", "lơ mơ", "hạ huyết áp",
    "hạ thân nhiệt",
]
DIAGNOSIS_TERMS = [
    "xơ gan", "hội chứng não gan", "tăng huyết áp", "phình động mạch chủ", "bệnh tim mạch do xơ vữa động mạch", "rung nhĩ", "nhồi máu cơ tim", "khối u trực tràng",
    "u ác trực tràng", "u tuyến", "bệnh động mạch vành", "tăng calci máu", "viêm mô tế bào", "ngoại tâm thu nhĩ", "ngoại tâm thu thất", "tim to",
    "u ác của đại tràng", "cường cận giáp nguyên phát", "xơ vữa động mạch", "cơn đau thắt ngực ổn định", "ung thư biểu mô tế bào thận",
    "ung thư biểu mô tuyến giáp nhú", "ung thư biểu mô tuyến giật nhú", "ung thư biểu mô tuyến", "khối ở chỗ uốn gan", "u ác của đầu tuỵ", "u ác của đầu tụy",
    "khối u có nguồn gốc từ đường mật tụy", "gãy xương sườn", "đụng dập nhu mô phổi", "vết thương thấu bụng", "tổn thương dây thanh quản",
    "nhiễm trùng đường tiết niệu kháng thuốc", "đại tràng giãn", "ung thư vú di căn", "tràn dịch màng phổi trái tái phát", "tràn dịch màng ngoài tim",
    "đa u tủy xương", "tổn thương chi dưới", "thuyên tắc phổi", "nhiễm trùng chi dưới",
]
DRUG_HEADERS = ["thuốc trước khi nhập viện", "thuốc trước khi nhập viện lần này", "danh sách thuốc trước nhập viện", "xử trí thuốc"]
DIAGNOSIS_HEADERS = [
    "tiền sử bệnh nội khoa", "các bệnh lý mãn tính", "bệnh lý mãn tính", "các bệnh đã điều trị trước đây", "các bệnh lý mạn tính", "bệnh mãn tính",
    "bệnh mạn tính", "các phát hiện chẩn đoán khác", "kết quả chẩn đoán hình ảnh", "kết quả hình ảnh", "chẩn đoán sơ bộ",
]
SYMPTOM_HEADERS = [
    "triệu chứng hiện tại", "triệu chứng khi nhập viện", "các triệu chứng hiện tại", "đặc điểm triệu chứng khi khám tại khoa cấp cứu",
    "thời điểm khởi phát triệu chứng", "triệu chứng lúc vào", "dấu hiệu lâm sàng", "tình trạng lúc vào viện", "tình trạng vào khoa cấp cứu",
]
HEALTHY_PHRASES = ["không có bệnh lý khác", "khỏe mạnh"]
GENERIC_PHRASES = ["không có bệnh lý khác", "khỏe mạnh", "ổn định về mặt huyết động", "đang chờ kết quả"]

LAB_NAME_REGEX = r"(?P<span>\b(?:WBC|RBC|HGB|HCT|PLT|NEUT%|LYPH%|AST|ALT|CRP|GLUCOSE|HbA1c|CBC|CEA|CR|creatinine|creatinin|troponin|kali|bilirubin(?:\s+toàn\s+phần)?|bạch cầu|tiểu cầu|đường huyết(?:\s+lúc\s+đói)?|canxi(?:\s+ion\s+hóa)?|công thức máu)\b(?:\s*\([^)]*\))?)"
LAB_VALUE_REGEX = r"[:\-]?\s*(?P<span>\d+(?:[.,]\d+)?(?:\s?(?:%|mg/ml|mmol/l|g/dl|10\^9/l))?)"
DRUG_REGEX = r"\b(?P<span>[A-Za-zÀ-ỹđĐ][A-Za-zÀ-ỹđĐ0-9./\-]*(?:[ \t]+[A-Za-zÀ-ỹđĐ0-9./\-]+){0,5}[ \t]+\d+(?:[.,-]\d+)?\s*(?:mg/ml|mcg/ml|mg|mcg|g|ml)(?:[ \t]+[a-z0-9./:\-]+){0,4})\b"
DRUG_LINE_REGEX = r"(?P<span>\b[a-z][a-z0-9./\-]*(?:[ \t]+[a-z0-9./\-]+){0,5}(?:[ \t]+\d+(?:[.,-]\d+)?\s*(?:mg/ml|mcg/ml|mg|mcg|g|ml)(?:[ \t]+[a-z0-9./:\-]+){0,4})?)"
COUGH_TAIL_REGEX = r"(?:\s+đờm(?:\s+[A-Za-zÀ-ỹđĐ]+)?|\s+khan|\s+ra máu)"
STRENGTH_REGEX = r"(\d+(?:[.,]\d+)?)\s*(mg/ml|mcg/ml|mg|mcg|g|ml)\b"
ROUTE_REGEX = r"\b(po|iv|im|sc|subq|bid|tid|qid|daily|once|prn|nebs?|nebulizer)\b"
PRODUCT_LABEL_REGEX = r"(?:containing product|oral|tablet|capsule|solution|injection|\[|\b\d+(?:[.,]\d+)?\s*(?:mg|mcg|g|ml)\b)"
MULTI_CODE_REGEX = r"(?:/|\+|\ber\b|\bher2\b)"

NOT_DRUG_LEADS = ["theo", "mất", "một", "và", "các", "bệnh", "ngày"]
NOT_DRUG_PHRASES = ["nước tiểu", "ống thông", "tiểu cầu", "bạch cầu", "ure", "creatinine", "giảm lượng", "xuống còn", "lên 6.3", "sau đó giảm xuống", "sau đó 30 mg", "total of", "decreased from", "reduced from"]
NOT_DRUG_WORDS = ["bid", "daily", "once", "tid", "qid", "dose"]
NOT_DRUG_STARTS = ["x ", "iv ", "po ", "im "]
DRUG_LINE_STOPS = [" cho ", " điều trị ", " (", ","]
DRUG_DOSE_STOPS = [" dose ", " reduced from ", " decreased from "]
DRUG_LIST_STOPS = [" và ", ", cùng ", " cùng ", ";"]
DRUG_CUES = [" dùng ", " sử dụng ", " điều trị ", " chỉ định "]
DRUG_LEAD_REGEX = r"^(?:(?:thuốc trước khi nhập viện(?: lần này)?|trước khi nhập viện|bệnh nhân có tiền sử sử dụng|có tiền sử sử dụng|tiền sử sử dụng|bắt đầu dùng|được chỉ định điều trị|được cho dùng|được cho|cho po|điều trị|sử dụng|dùng|nhận|tự điều trị bằng|điều trị bằng|bằng|liều cao)\s*[:\-]?\s*)+"
DRUG_REGIMEN_REGEX = r"\b(?:po|iv|im|bid|tid|qid|daily|once|nebs?|nebulizer)\b.*$"

NEGATION_CUES = ["không", "chưa", "phủ nhận", "âm tính với", "không có", "loại trừ"]
DOUBLE_NEGATIONS = ["không loại trừ", "chưa loại trừ", "không thể loại trừ", "không hoàn toàn loại trừ"]
NOT_SCOPING = ["không rõ", "không đặc hiệu", "không xác định", "không dung nạp"]
FAMILY_CUES = ["bố", "mẹ", "cha", "anh", "chị", "em", "người nhà", "gia đình"]
HISTORY_CUES = ["tiền sử", "đã từng", "trước đây", "dùng lâu dài", "thuốc trước khi nhập viện", "trước nhập viện", "đã điều trị trước đây"]
DRUG_HISTORY_CUES = ["thuốc trước khi nhập viện", "trước khi nhập viện"]
CONTRAST_CUES = [" nhưng ", " tuy nhiên ", " song ", " dù vậy "]

DIAGNOSIS_QUERY_LEADS = r"^(?:nghi ngờ|tiền sử lâu dài của|tiền sử|mới được chẩn đoán|là)\s+"
DIAGNOSIS_QUERY_STOPS = [",", ";", " nghi ", " cách đây ", " điều trị ", " nhưng ", " biến chứng ", " có ", " và "]
DRUG_QUERY_LEADS = r"^(?:được cho dùng|được cho|nhận|cho po|iv|po|uống)\s+"
DRUG_QUERY_DOSES = r"^(?:bằng liều cao|liều cao)\s+"
DRUG_QUERY_TAIL = r"\b(?:x\s*\d+|po|iv|im|bid|tid|qid|daily|once|nebs?|nebulizer)\b.*$"

ABBREVIATIONS = {
    "tha": "tăng huyết áp", "đtđ": "đái tháo đường", "dm": "đái tháo đường", "copd": "bệnh phổi tắc nghẽn mạn tính", "af": "rung nhĩ", "sob": "khó thở",
    "mi": "nhồi máu cơ tim", "cad": "bệnh động mạch vành", "ckd": "bệnh thận mạn", "chf": "suy tim sung huyết", "xhth": "xuất huyết tiêu hóa",
    "gerd": "trào ngược dạ dày thực quản", "ecg": "điện tâm đồ", "mri": "cộng hưởng từ", "cea": "kháng nguyên ung thư phôi", "osh": "bệnh viện tuyến trước",
}

RXNORM_TTYS = ["IN", "PIN", "BN", "SCD", "SBD", "SCDG", "SBDG", "GPCK", "BPCK"]
SOURCE_BONUS = {"exact": 0.16, "indexed": 0.06, "embedding": 0.03, "gold": 0.0}
NER_LABELS = {
    "SYMPTOM": SYMPTOM, "TRIEU_CHUNG": SYMPTOM, SYMPTOM: SYMPTOM, "DIAGNOSIS": DIAGNOSIS, "CHAN_DOAN": DIAGNOSIS, DIAGNOSIS: DIAGNOSIS, "DRUG": DRUG,
    "THUOC": DRUG, DRUG: DRUG, "LAB_NAME": LAB_NAME, "TEST_NAME": LAB_NAME, LAB_NAME: LAB_NAME, "LAB_VALUE": LAB_VALUE, "TEST_VALUE": LAB_VALUE, LAB_VALUE: LAB_VALUE,
}


def bio_labels(types: list[str] = ENTITY_TYPES) -> list[str]:
    """O, then B- and I- of each type; a label's place is its id."""
    return ["O", *(f"{p}-{t}" for t in types for p in "BI")]
