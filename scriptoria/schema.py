"""Spark types of the engine's records, as DDL."""

POINT = "array<double>"
POLYGON = "array<array<double>>"
ISSUE = "struct<start:int,end:int,category:string,reason:string,suggestion:string>"
VALIDATION = f"struct<text_hash:string,model:string,checked_at:timestamp,issues:array<{ISSUE}>>"
#: A block of a page; OCR blocks leave layout_label, task and validation null.
BLOCK = f"struct<id:string,order:int,text:string,polygon:{POLYGON},score:double,source:string,layout_label:string,task:string,skipped:boolean,validation:{VALIDATION}>"
IMAGE = "struct<path:string,width:int,height:int,sha256:string>"
ANNOTATION = f"version int, image {IMAGE}, revision long, status string, text string, blocks array<{BLOCK}>, updated_at timestamp"
LABEL = "struct<transcription:string,points:array<array<int>>>"
REJECTION = "dataset string, split string, row_index long, reason string, detail string"
LABEL_REJECTION = "dataset string, label_file string, line_number long, box_index int, reason string, detail string"
PREDICTION = "candidate string, dataset string, image string, target string, task string, prediction string, runtime_seconds double, max_new_tokens int, generated_tokens int, ended_with_eos boolean, truncated boolean, finish_reason string"
COCO = "images array<struct<id:long,file_name:string,width:long,height:long>>, annotations array<struct<id:long,image_id:long,category_id:long,segmentation:array<array<double>>,bbox:array<double>,area:double,iscrowd:int,read_order:long>>, categories array<struct<id:long,name:string>>"
