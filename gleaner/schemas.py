"""The declared shapes of the engine's tables."""

from __future__ import annotations

CATALOG = "section_ord int, section_key string, name string, start_url string, pager_pattern string, description string"
LISTING = "section_key string, page_num int, page_url string, http_status int, html string, error string"
ANCHOR = "struct<pos:int,href:string,text:string,url:string>"
ARTICLE = "struct<pos:int,url:string,title:string,date:string>"
DOCUMENT = "struct<pos:int,download_url:string,link_text:string,document_id:string,article_id:string,module_id:string,article_title:string,article_url:string>"
PARSED = f"struct<title:string,anchors:array<{ANCHOR}>,pager:struct<template:string,max_page:int>,articles:array<{ARTICLE}>,documents:array<{DOCUMENT}>>"
EVENT = (
    "seq long, doc_key string, document_id string, article_id string, section string, filename string, file_path string, file_size_bytes long,"
    " article_title string, article_url string, download_url string, link_text string, status string, error string, reason string, timestamp timestamp"
)
RESPONSE = "url string, status int, headers map<string,string>, body binary, error string"
DOWNLOAD = "seq long, ok boolean, filename string, file_size_bytes long, error string"
COUNTERS = ("listing_pages_crawled", "articles_visited", "pdfs_discovered", "pdfs_downloaded", "pdfs_skipped", "pdfs_failed")
