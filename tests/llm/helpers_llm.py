import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
