"""License wordings as templates with markup.

``<<beginOptional>> ... <<endOptional>>`` may be left out whole (regions may
nest); a template begins with a word; ``<<var;name=...;words=N-M>>`` stands for N to M words of any kind. All
else is mandatory wording. Case and punctuation don't count.
"""

_NAMED = "<<beginOptional>>the<<endOptional>>"
_COPYRIGHT = "<<beginOptional>>copyright <<var;name=notice;words=0-40>><<endOptional>>"

_BSD_START = f"""{_COPYRIGHT} Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: <<beginOptional>>1<<endOptional>> Redistributions of source code must retain
the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2<<endOptional>>
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution."""

_BSD_END = """THIS SOFTWARE IS PROVIDED BY <<var;name=holder;words=1-20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL <<var;name=holder;words=1-20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""

_GPL_HEADER = """is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation; either version {0} of the License, or (at your option)
any later version."""

_CC_NAMES = {"CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-NC-4.0": "Attribution-NonCommercial",
             "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike", "CC-BY-ND-4.0": "Attribution-NoDerivatives"}


def _named(label: str, *names: str) -> list[tuple[str, str]]:
    """Notices that release a work under a license by its name."""
    return [(label, f"{verb} under {_NAMED} <<beginOptional>>terms of the<<endOptional>> {name}")
            for name in names for verb in ("released", "licensed", "distributed", "available")]


#: (label, template); labels are the licenses' usual identifiers.
TEMPLATES: list[tuple[str, str]] = [
    *_named("MIT", "MIT License"),
    *_named("Apache-2.0", "Apache License<<beginOptional>>,<<endOptional>> Version 2.0", "Apache License 2.0"),
    *_named("GPL-2.0", "GNU General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>>, version 2",
            "GPL version 2", "GPLv2"),
    *_named("GPL-3.0", "GNU General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>>, version 3",
            "GPL version 3", "GPLv3"),
    *(x for label, name in _CC_NAMES.items()
      for x in _named(label, label.replace("-", " "),
                      f"<<beginOptional>>a<<endOptional>> Creative Commons {name} 4.0 International<<beginOptional>> License<<endOptional>>")),
    ("GPL-2.0", _GPL_HEADER.format(2)),
    ("GPL-3.0", _GPL_HEADER.format(3)),
    ("MIT", f"""<<beginOptional>>The MIT License<<beginOptional>> (MIT)<<endOptional>><<endOptional>> {_COPYRIGHT}
Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name=what;words=1-6>> and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<var;name=holder;words=1-20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", f"""<<beginOptional>>ISC License<<endOptional>> {_COPYRIGHT} Permission to use, copy, modify, and/or distribute this
software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name=holder;words=1-20>> DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
<<var;name=holder;words=1-20>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT
OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", f"{_BSD_START} {_BSD_END}"),
    ("BSD-3-Clause", f"""{_BSD_START} <<beginOptional>>3<<endOptional>> Neither the name of <<var;name=holder;words=1-20>> may be used
to endorse or promote products derived from this software without specific prior written permission. {_BSD_END}"""),
    ("Apache-2.0", """you may not use <<var;name=what;words=1-4>> except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""),
]
