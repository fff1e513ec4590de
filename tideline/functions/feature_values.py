"""Patterns that decide features of a listing's text. All but the last two run on search_form text."""

LEGAL = r"\b(phap ly|so do|so hong|so rieng|so chung|da co so|hop dong mua ban|hdmb|giay to hop le|chua co so|vi bang|giay tay|cong chung|sang ten|quy hoach|tranh chap)\b"
RED_PINK_BOOK = r"\b(so do|so hong|so rieng)\b"
GROUND_AND_FLOORS = r"\b\d+\s*tret\s+(\d{1,2})\s*lau\b"
FLOORS = r"\b(?:so tang|xay dung|ket cau|nha)?\s*[:\-]?\s*(\d{1,2})\s*(?:tang|lau)\b|\b(\d{1,2})\s*t\b"
OWNER = r"\b(khong tiep moi gioi|khong tiep mg|mien moi gioi|khong qua moi gioi|chinh chu|chu nha|chu can ban|chu gui|ban truc tiep)\b"
BROKER = r"\b(moi gioi|mg|sale|nhan ky gui|van phong nha dat|cong ty bds)\b"
FURNITURE = {
    "full": r"\b(full noi that|full do|noi that day du|day du noi that|noi that cao cap|noi that dep|noi that xin|de lai toan bo noi that|du do vao o ngay)\b",
    "basic": r"\b(noi that co ban|do co ban|ban giao co ban|ban giao hoan thien|hoan thien co ban)\b",
    "raw": r"\b(nha tho|ban giao tho|tho hoan thien|can tho|chua co noi that)\b",
    "mentioned": r"\b(dieu hoa|nong lanh|tu bep|giuong|sofa|tivi|tu lanh|may giat|bep tu|noi that)\b",
}
FRONTAGE = (r"\b(?:mat tien|mt|nong|chieu ngang|ngang)\s*[:\-]?\s*(\d+(?:[.,]\d+)?)\s*m(?![23])\b", r"\b(\d+(?:[.,]\d+)?)\s*m(?![23])\s*(?:mat tien|ngang)\b")
BATHROOMS = (r"\b(\d{1,2})\s*(?:phong tam|wc|vs|ve sinh|nha ve sinh|toilet)\b", r"\b(?:wc|vs|ve sinh|so phong tam)\s*[:\-]?\s*(\d{1,2})\b")
BEDROOMS = (r"\b(\d{1,2})\s*(?:phong ngu|pn|ngu)\b", r"\bso phong ngu\s*[:\-]?\s*(\d{1,2})\b", r"\b(\d{1,2})n(?:\d{1,2}(?:k|vs|wc))?\b")
BUSINESS = r"\b(kinh doanh|kd|mat pho|mat duong|mat tien kinh doanh|vua o vua kinh doanh|buon ban|mo cua hang|mo van phong|cho thue kinh doanh|dong tien|shophouse|nha pho thuong mai|shop|spa|cafe|nha hang|mat bang|van phong)\b"
URBAN = r"\b(kdt|khu do thi|khu do thi moi|urban|city|residence|garden|park)\b"
RESIDENTIAL = r"\b(khu dan cu|kdc|dan cu dong duc|dong dan cu|khu dan sinh)\b"
SECURITY = r"\b(an ninh|an ninh tot|bao ve 24/7|camera|khu an ninh)\b"
EDUCATED = r"\b(dan tri cao|hang xom van minh|cong dong van minh)\b"
SUBDIVISION = r"\b(phan lo|khu phan lo|dat phan lo|biet thu phan lo)\b"
DIRECTION = r"\b(?:huong nha|nha huong|dat huong|huong)\s*[:\-]?\s*(dong nam|tay bac|dong bac|tay nam|dong|tay|nam|bac|dn|tb|db|tn)\b"
DIRECTION_SHORT = {"dn": "dong_nam", "tb": "tay_bac", "db": "dong_bac", "tn": "tay_nam"}
NEGOTIABLE = r"\b(?:thuong luong|co thuong luong|gia thuong luong|thoa thuan|gia thoa thuan|co tl|tl manh|bot loc|gia chao|gia tot cho khach thien chi|khach thien chi co thuong luong)\b"
NEGATION = r"\b(khong|chua|khong co)(?:\s+\w+){0,2}\s+$"
CAR_ACCESS = {
    "car_can_enter": r"\b(o to vao|oto vao|xe hoi vao|oto vao nha|o to vao nha)\b",
    "car_can_park": r"\b(o to do|oto do|o to do cua|oto do cua|cho de o to|bai do xe|gara|garage|o to ngu trong nha|oto ngu trong nha)\b",
    "car_can_pass": r"\b(o to tranh|oto tranh|duong o to|duong oto|ngo o to|ngo oto|hem xe hoi)\b",
}
PROJECT = r"\b(?:du an|dự án|chung cu|chung cư|khu do thi|khu đô thị)\s+([^.,;\n\r\-]{1,120})"
BUILDING = r"\b(?:toa|tòa|toà|thap|tháp|block|tower)\s+([A-Za-zÀ-ỹ0-9][A-Za-zÀ-ỹ0-9.\-\s]{0,49})"
#: Features that make no sense for a type of property.
SKIPPED = {"apartment": ("floor_count", "frontage_width", "has_car_access", "car_access_type"), "land": ("floor_count", "bedroom_count")}
