"""Text, price, feature, field and crawl functions against literal tables."""

import json

import pytest
from pyspark.sql import functions as F

from tideline.functions import extract, features, price, text
from tideline.operators import crawl
from tideline.sources import web


def ask(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_text(spark):
    assert ask(spark, ["  a\t b ", "x·y • z", "  ", None], text.clean_text) == ["a b", "x y z", None, None]
    assert ask(spark, ["  Nhà Đẹp Hà Nội 50 m²\n", None, " ", "Quận 1 ㎡"], text.search_form) == ["nha dep ha noi 50 m2", "", "", "quan 1 m2"]
    assert ask(spark, ["3.500.000 đ", "3,5 tỷ", "no", None], text.first_number) == [3.5, 3.5, None, None]
    assert ask(spark, ["Quận Đống Đa!", "", "A--b"], text.slug) == ["qu_n_ng_a", "unknown", "a_b"]
    assert ask(spark, ["Quận Đống Đa!"], text.accent_slug) == ["quan-dong-da"]
    assert ask(spark, ["https://x/pr123", "https://x/y"], text.url_listing_id)[0] == "123"
    assert ask(spark, ["2024-02-30", "2024-02-03", None], text.date_key) == [None, 20240203, None]


def test_price(spark):
    got = ask(spark, ["3,799 tỷ", "Thỏa thuận", "85 triệu/m²", "12 triệu", "5000 VND", "7", "", None], price.price)
    assert [(r.value, r.unit, r.vnd) for r in got] == [(3.799, "ty", 3799000000), (None, "negotiable", None), (85.0, "million_per_m2", 85000000), (12.0, "million", 12000000), (5000.0, "vnd", 5000), (7.0, None, None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame([(100, 50.0, "ty"), (100, 0.0, "ty"), (100, None, "million_per_m2"), (100, 2.5, "million_per_m2"), (None, 1.0, None)], "v long, a double, u string")
    c = F.col
    assert [tuple(r) for r in df.select(price.unit_price(c("v"), c("a"), c("u")), price.total_price(c("v"), c("a"), c("u"))).collect()] == [(2.0, 100), (None, 100), (100.0, None), (100.0, 250), (None, None)]


def feature(spark, name, values, kind=None):
    df = spark.createDataFrame([(i, v, kind) for i, v in enumerate(values)], "i int, title_raw string, property_type_group string")
    return [r[name] for r in features.with_features(df, ("title_raw",)).orderBy("i").collect()]


@pytest.mark.parametrize(
    "name,cases",
    [
        ("legal_status_raw", {"gan cho, giay tay tu 2010": "giay tay", "moi co vi bang": "vi bang", "gio mat": None}),
        ("has_red_pink_book", {"so hong trong tay": True, "giay tay": False, "cay xanh": False}),
        ("floor_count", {"xay 2 tret 5 lau moi": 6, "ket cau 7 lau": 7, "60 tang": None, "cao 4t": 4}),
        ("seller_type", {"chu gui gap": "owner", "van phong nha dat an": "broker", "gan song": None}),
        ("furniture_level", {"Đầy đủ nội thất": "full", "do co ban": "basic", "nha tho 2 mat": "raw", "co tu lanh": "mentioned"}),
        ("frontage_width", {"rong 60 m2": None, "chieu ngang 6,5 m": 6.5, "7m mat tien": 7.0, "nong 300 m": None}),
        ("bathroom_count", {"2 toilet": 2, "so phong tam: 4": 4, "35 vs": None}),
        ("bedroom_count", {"5 phòng ngủ": 5, "2n1k": 2, "so phong ngu: 6": 6}),
        ("direction", {"gan bac ninh": None, "dat huong tay nam": "tay_nam", "huong db": "dong_bac"}),
        ("is_price_negotiable", {"chua tung thoa thuan": False, "bot loc cho nguoi mua": True, "khong phai la gia chao": False, "khong can voi vang thuong luong": True, "chua co tl, nhung bot loc": True}),
        ("car_access_type", {"duong oto rong": "car_can_pass", "bai do xe, xe hoi vao": "car_can_park", "di bo": None}),
        ("project_name", {"Chung cư Hoa Lan, tầng 5": "Hoa Lan", "x": None}),
        ("building_name", {"Block B7 thoáng, gần hồ": "B7 thoáng", "x": None}),
        ("has_urban_area_flag", {"Gần garden lớn": True, "x": False}),
    ],
)
def test_features(spark, name, cases):
    assert feature(spark, name, list(cases)) == list(cases.values())


def test_features_skipped_and_blank(spark):
    words = "6 lau chieu ngang 4m xe hoi vao 2 phong ngu"
    assert [feature(spark, n, [words], "apartment")[0] for n in ("floor_count", "frontage_width", "has_car_access", "bedroom_count")] == [None, None, None, 2]
    assert [feature(spark, n, [words], "land")[0] for n in ("floor_count", "bedroom_count", "has_car_access")] == [None, None, True]
    assert feature(spark, "has_legal_info", [None, " "]) == [None, None]
    row = features.with_features(spark.createDataFrame([(" ", 2)], "title_raw string, bathroom_count int"), ("title_raw",)).first()
    assert row.bathroom_count is None


RAW = "Chính chủ bán nhà 4 tầng đẹp\nMức giá\nx\n5,2 tỷ\nDiện tích 50 m²\nĐịa chỉ: Đống Đa, Hà Nội\n3 phòng ngủ, 2 toilet\nNgày đăng: 01/02/2024"


def test_fields(spark):
    df = spark.createDataFrame([(1, RAW, None), (2, "Khoảng giá Thỏa thuận", "Quận 1"), (3, None, None), (4, "DT 80m2 giá chỉ 3 tỷ", None)], "i int, raw_text string, crawl_district string")
    a, b, c, e = extract.with_quality(extract.parsed(df)).orderBy("i").collect()
    assert (a.title_raw, a.price_raw, a.area_raw, a.location_raw) == ("Chính chủ bán nhà 4 tầng đẹp", "5,2 tỷ", "50 m²", "Đống Đa, Hà Nội")
    assert (a.price_vnd, a.area_m2, a.bedroom_count, a.bathroom_count, a.city_norm, a.posted_date_raw, a.parse_status) == (5200000000, 50.0, 3, 2, "Hà Nội", "01/02/2024", "success")
    assert (b.price_unit, b.location_parse_method, b.location_confidence, b.is_missing_price, b.parse_status) == ("negotiable", "crawl_context", "medium", False, "partial_success")
    assert (c.title_raw, c.price_raw, c.location_parse_method, c.parse_status) == (None, None, "unknown", "partial_success")
    assert (e.price_vnd, e.area_m2, e.unit_price_vnd_m2) == (3000000000, 80.0, 37500000.0)


def test_quality_edges(spark):
    rows = [("0", "vnd", "-1"), ("abc", None, "x"), ("99999999", "vnd", "4"), ("1000000000001", "vnd", "10001"), (None, None, None)]
    df = spark.createDataFrame([(*r, "d") for r in rows], "price_vnd string, price_unit string, area_m2 string, district_norm string")
    got = extract.with_quality(df).collect()
    assert [(r.is_invalid_price, r.is_outlier_price, r.is_invalid_area, r.is_outlier_area) for r in got] == [(True, True, True, True), (True, False, True, False), (False, True, False, True), (False, True, False, True), (False, False, False, False)]


ADS = {"ads": [{"ad_id": 333, "list_id": 3330, "category_slug": "c", "location_slug": "l", "subject": "S", "price_string": "4,5 ty", "price": 4500000000, "size": 72, "region_name": "Ha Noi", "area_name": "Ba Dinh", "ward_name": "Doi Can", "rooms": 2}, {"ad_id": 4440, "region_name": "Hà Nội", "area_name": "Đống Đa"}, {"subject": "no identity"}]}


def test_ads(spark):
    state = json.dumps({"props": {"pageProps": {"initialState": {"adlisting": {"data": ADS}}}}})
    df = spark.createDataFrame([(1, json.dumps(ADS)), (2, f'<html><script id="__NEXT_DATA__" type="application/json">{state}</script></html>'), (3, "<p>"), (4, "{bad")], "page int, payload string")
    got = sorted(web.ads(df).collect(), key=lambda r: (r.page, r.listing_id))
    assert [(r.page, r.listing_id) for r in got] == [(1, "333"), (1, "4440"), (2, "333"), (2, "4440")]
    assert got[0].listing_url == "https://www.nhatot.com/c-l/3330.htm" and got[0].listing_card_area_raw == "72 m2" and got[0].listing_card_location_raw == "Doi Can, Ba Dinh, Ha Noi"
    assert got[1].listing_url == "https://www.nhatot.com/mua-ban-nha-dat-dong-da-ha-noi/4440.htm"


def test_html(spark):
    page = "<html><head><style>x</style><title>T</title></head><body><script>bad</script><p>a <b>b</b></p>\n c &amp; d<!-- no --></body></html>"
    assert ask(spark, [page, None], web.html_text) == ["T\na\nb\nc & d", ""]
    card = '<div class="js__card js__card-listing"><a href="/ban-nha-pr12"><h3 class="re__card-title">Nhà <b>A</b></h3></a><span class="re__card-config-price">5 tỷ</span><span class="re__card-location">P1 (Q2 cũ)</span></div>'
    df = spark.createDataFrame([(1, f"<body>{card}{card.replace('5 tỷ', '6 tỷ')}{card.replace('pr12', 'x')}</body>")], "page int, html string")
    (r,) = web.cards(df).collect()
    assert (r.listing_url, r.listing_card_title, r.listing_card_price_raw, r.listing_card_old_district_raw) == ("https://batdongsan.com.vn/ban-nha-pr12", "Nhà A", "5 tỷ", "Q2 cũ")
    detail = '<h1 class="re__pr-title">Bán nhà</h1><span class="re__address-line-1">HN</span><div class="js__breadcrumb"><a>A</a> / <a>B</a></div>'
    r = spark.createDataFrame([(detail,)], "h string").select(*(v.alias(k) for k, v in web.detail_fields(F.col("h")).items())).first()
    assert (r.detail_title, r.detail_address_raw, r.breadcrumb_raw, r.detail_description) == ("Bán nhà", "HN", "A / B", None)


def test_crawl(spark):
    df = spark.createDataFrame([(403, "", 5), (200, "x G-Recaptcha", None), (200, "x g-recaptcha", 3), (200, "__cf_chl", 0), (200, "fine", None)], "s int, h string, n int")
    assert [r[0] for r in df.select(crawl.block_reason(F.col("s"), F.col("h"), F.col("n"))).collect()] == ["http_403", "captcha", None, "cloudflare_challenge", None]
    rows = [("Quận Ba Đình", None, None, False), ("Quận Cầu Giấy", "ba dinh", None, True), (None, "Tây Hồ xa", None, True), (None, None, "https://x/ba-dinh/1", False), (None, None, None, True), (None, None, None, False)]
    df = spark.createDataFrame(rows, "detail_address_raw string, listing_card_location_raw string, listing_url string, is_seed_url_valid boolean")
    got = [r[0] for r in df.select(crawl.place_evidence(df, F.lit("Ba Đình"), F.lit("ba-dinh"), F.lit("ba-dinh"), ("Ba Đình", "Cầu Giấy"))).collect()]
    assert [(r.match_status, r.match_method) for r in got] == [("matched", "detail_address_block"), ("mismatch", "detail_address_block_contains_other_location:Cầu Giấy"), ("mismatch", "listing_card_location_does_not_match_target"), ("matched", "detail_url_contains_location_path"), ("assumed_from_seed", "seed_url_context"), ("unknown", "no_location_evidence")]
    assert ask(spark, ["Căn hộ đẹp", "kho"], lambda x: crawl.category_matches(x, F.lit("ban-can-ho-chung-cu"))) == [True, False]
