"""Declared schemas of the canonical tables, as DDL."""

#: Output rows: tokens and shapes with their role, place and order.
DATA = (
    "doc_id string, pos int, reading_order int, label string, block_id int, section_id int, text string, page_no int, x0 double, y0 double, x1 double, y1 double, "
    "font string, font_size double, flags array<string>, tex string, page_size array<double>, line_no int"
)
TOC = ("section_id int, nested_to int")
TOKENS = (
    "doc_id string, pos int, page_no int, text string, font string, font_size double, color string, x0 double, top double, x1 double, bottom double, page_size array<double>, flags array<string>, line_no int"
)
SHAPES = ("doc_id string, page_number int, x0 double, y0 double, x1 double, y1 double, stroking_color array<double>, page_size array<double>")
ANNOTATIONS = ("doc_id string, color_key string, label string, reading int, section int, block int, tex string")
GOLD = ("token string, x0 double, y0 double, x1 double, y1 double, r int, g int, b int, fontname string, label string")
RESPONSE = ("success boolean, has_output boolean, log string, main_tex_files array<string>, output array<struct<type:string, path:string, contents:string>>")
PACKAGE = ("includes array<string>, cmds map<string,string>, envs map<string,string>")
