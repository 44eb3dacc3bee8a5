"""Spark schemas (as DDL, so that importing needs no session) and fixed parameters."""

from __future__ import annotations

BOX = "struct<x0:int,y0:int,x1:int,y1:int>"
REGION = (
    f"struct<id:int,bbox:{BOX},class:string,raw_text:string,legibility:string,spell_check_full_text:string,"
    "spell_check_period:string,spell_check_paragraph:string,spell_check_word:string,full_article_id:int,reading_order_id:int>"
)
FULL_ARTICLE = (
    f"struct<object_ids:array<int>,headline:string,article:string,byline:string,bbox_list:array<{BOX}>,bbox:array<int>,"
    "full_article_id:int,id:string>"
)
#: One scan document; the JSON key of the articles has a blank.
SCAN_DDL = (
    "page_number string, scan_url string, scan_ocr string, scan struct<height:int,width:int,jp2_url:string,dimensions_approx:boolean>, "
    f"edition struct<date:string>, bboxes array<{REGION}>, `full articles` array<{FULL_ARTICLE}>"
)
ARTICLE = ("article_id string, date date, headline string, byline string, article string, year int")
TITLE = (
    "title string, geonames_ids array<string>, dbpedia_ids array<string>, issn string, lccn string, start_year string, end_year string, "
    "languages array<string>, succeeds array<string>, successors array<string>, editions array<string>")
EDITION = ("lccn string, edition string, date string, pages array<string>")
PAGE = ("lccn string, edition string, date string, page string, jp2_url string, ocr_text_url string, ocr_xml_url string, raw_data_loc string")
PAGE_RECORD = "struct<page_number:string,page_url:string,page_ocr:string,reel_number:string,reel_sequence_number:string>"
MANIFEST = (
    "paper_name string, paper_date string, paper_city string, paper_state string, paper_url string, lccn string, volume string, issue string, "
    f"edition string, pages map<string,{PAGE_RECORD}>")
DETECTION = ("x0 float, y0 float, x1 float, y1 float, conf float, cls int")
ERRORS = ("filename string, stage string, error string")

LAYOUT_CLASSES = ("article", "author", "cartoon_or_advertisement", "headline", "image_caption", "masthead", "newspaper_header", "page_number", "photograph", "table")
OCR_CLASSES = ("article", "author", "headline", "image_caption")
LEGIBILITY = ("Legible", "Questionable", "Illegible")
NO_LEGIBILITY = "NA"

OVERLAP_SHARE, SLACK_SHARE, GAP_SHARE = 100, 50, 10
COLUMN_MARGIN, ROW_MARGIN = 0.40, 0.10
PARAGRAPH_WEIGHTS, PARAGRAPH_LIMIT = (3.0, 1.0), 5.0
NMS_ROWS, NMS_CLASS_OFFSET = 30_000, 7_680
WORD_SIMILARITY = 0.86
END_PUNCTUATION = '.?!,;:"'
MIN_ARTICLE_TOKENS = 10
MANIFEST_CHUNK, INDEX_CHUNK = 100, 20
RELABEL_TOLERANCE = 0.001
