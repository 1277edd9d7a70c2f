"""Small source files of every kind that extraction knows, for its queries and tests."""

FILES = {
    "src/server.ts": """import { open, close as shut } from './files';
import type { Kind } from "./kinds.js";
import './setup';
import React from 'react';
// import { nothing } from './nothing'
export { shut as stop } from './files';
export * from './parts';
const text = "import bad from './in-text'";
const rule = /require\\('.\\/in-regex'\\)/;
const more = import('./lazy');
const old = require('../lib/old');
const shown = `a ${ open('x') + `b ${1}` } require('./in-template')`;
export const limit = 3;
export default function start() { return text; }
export abstract class Server<T> extends Base {
  private items: T[] = [];
  static create(): Server<string> { return new Server(); }
  async run(input: string) { if (input) { close(input); } }
}
interface Shape { area(): number }
type Name = string;
enum Level { Low, High }
namespace Tools { export function mend() {} }
""",
    "src/files.ts": "export const open = 1;\n",
    "src/kinds.ts": "export type Kind = 1;\n",
    "src/setup.js": "module.exports = {};\n",
    "src/lazy.tsx": "export default 1;\n",
    "src/parts/index.ts": "export {};\n",
    "lib/old.js": "module.exports = 1;\n",
    "ios/Shop.swift": """import UIKit
@testable import struct Core.Item
/* class Hidden { /* nested */ } */
let note = "class Fake { func no() {} }"
let long = \"\"\"
struct AlsoFake {}
\"\"\"
final class Shop {
    class func open() -> Shop { Shop() }
    func sell(id: Int) -> String { "item \\(id) }" }
    enum State { case on }
}
extension Shop.State {
    func show() {}
}
protocol Buyer { func pay() }
actor Till { func count() {} }
""",
    "go.mod": "module example.org/shop\n\nrequire (\n\tgithub.com/one/two v1.2.3 // indirect\n)\nrequire github.com/three/four v0.1.0\n",
    "cmd/main.go": """package main

import (
\t"fmt"
\tu "example.org/shop/util"
)

// func Hidden() {}
type (
\tConfig struct {
\t\tName string
\t}
\tCode int
)
type List[T any] struct{}

func (l *List[T]) Add(x T) {}
func main() {
\tfmt.Println(`type Fake struct{}`)
}
""",
    "bin/run.sh": """#!/bin/sh
# source ./comment.sh
source "$(dirname "$0")/lib.sh"
. ./shared.sh
source "$HOME/.rc"
echo "source ./quoted.sh"
cat <<END
source ./here.sh
END
setup() {
  :
}
function clean {
  :
}
""",
    "bin/lib.sh": "helper() { :; }\n",
    "bin/shared.sh": ":\n",
    "docs/guide.md": """---
title: No heading
---
# Guide
See [the server](../src/server.ts "Title") and ![picture](picture.png).

Second part
-----------

## Use of `code`
Also [named][n], not `[code](../src/none.ts)`.

[n]: ./more.md
<!-- [hidden](../src/none.ts) -->
```
[fenced](../src/none.ts)
```
### Deep [link](more.md)
# Last
""",
    "docs/more.md": "# More\n",
    "package.json": '{"dependencies": {"left": "1"}, "devDependencies": {"@in/right": "2"}, "scripts": {"x": "y"}}\n',
    "pyproject.toml": '[project]\nname = "x"\ndependencies = ["alpha>=1", "beta[extra]"]\n[project.optional-dependencies]\ndev = ["gamma"]\n[build-system]\nrequires = ["delta"]\n[tool.poetry.dependencies]\npython = "^3"\nepsilon = "*"\n',
    ".github/workflows/ci.yml": "on: push\njobs:\n  a:\n    steps:\n      - uses: org/tool@v1\n      - uses: ./.github/actions/prepare\n      - run: |\n          echo\n          uses: no/action@v1\n      - uses: docker://image:3\n",
    ".github/actions/prepare/action.yml": "runs:\n  using: composite\n",
    "pkg/__init__.py": "",
    "pkg/a.py": "import pkg.b\nimport outside\nfrom . import b\nfrom ...far import x\nclass One:\n    def two(self):\n        def three():\n            pass\n",
    "pkg/b.py": "def help():\n    pass\n",
    "pkg/broken.py": "def (:\n",
    "both.py": "import twice\n",
    "twice.py": "",
    "twice/__init__.py": "",
    "data.bin": "nothing",
}
